"""Find and restore text that was decoded with a wrong character encoding.

Every line of a text has a latent encoding chain: none, one wrong decoding, or two in a row. The likelihood of a line under a
chain is the character-bigram score of the line with the chain undone. Expectation-maximization over all lines of all
texts learns, for each (source, field), how often each chain occurs there, so that weak evidence in a short line is
judged with what the rest of its source shows; each line is then repaired by its posterior.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.session import bounded_broadcast, materialize

_WIDE = ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "mac_roman", "koi8-r", "cp866", "iso8859-15")
#: (encoding it was wrongly read in, encoding it was written in)
_NARROW = (
    ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp1251", "cp1252"), ("cp1250", "cp1252"),
    ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "cp1251"), ("cp1252", "koi8-r"), ("cp1252", "cp866"),
    ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "koi8-r"), ("cp1251", "cp866"), ("cp866", "koi8-r"), ("koi8-r", "cp866"), ("mac_roman", "cp1251"),
)
#: Latent chains: steps that undo the damage, in order. The first, empty one is sound text.
CHAINS: tuple[tuple[tuple[str, str], ...], ...] = (
    (),
    *(((w, "utf-8"),) for w in _WIDE),
    *(((a, "utf-8"), (b, "utf-8")) for a in ("cp1252", "latin-1", "cp437", "mac_roman", "cp1251", "cp1250", "cp850") for b in ("cp1252", "latin-1", a) if a == b or b in ("cp1252", "latin-1")),
    *((pair,) for pair in _NARROW),
)
CHAINS = tuple(dict.fromkeys(CHAINS))
NAMES = tuple("+".join(f"{true}>{wrong}" for wrong, true in chain) or "sound" for chain in CHAINS)
#: For each chain, the chain of its first step alone.
_FIRST = tuple(CHAINS.index(chain[:1]) for chain in CHAINS)
#: Among the chains of a text with characters that no chain restores.
DESTROYED = "lost"
LOST = "�"
_RUN = re.compile(r"[^\x00-\x7f]+")
_MULTI = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")
_SPACED = re.compile(r"[^ \t\n\r\f\v]+")
_C1 = re.compile("[\x80-\x84\x86-\x9f]")
PRIOR = 0.04
#: Weight of a chain of two steps against one of one step before anything is learned.
TWICE = 0.05
#: Rounds of expectation-maximization end when no share moves by more than this; far fewer than the most are needed.
SETTLED, ROUNDS = 1e-4, 50
LEAST = 0.5
#: A word is left for another chain, or as it is, where that is more likely by this logarithm.
CLEARLY = 8.0
#: Adjacent characters in the score model; of more, those seen most often are kept, and the others are scored by single characters.
MOST_PAIRS = 2_000_000


def first_shares() -> list[float]:
    weights = [TWICE if len(chain) > 1 else 1.0 for chain in CHAINS[1:]]
    return [1 - PRIOR, *(PRIOR * w / sum(weights) for w in weights)]


def _table(encoding: str) -> dict[str, int]:
    """Character to byte; bytes without a character stand for the control character of that number, as lenient readers do."""
    table: dict[str, int] = {}
    for byte in range(128, 256):
        ch = bytes([byte]).decode(encoding, "replace")
        table[chr(byte) if ch == LOST else ch] = byte
    if encoding.startswith("cp125"):
        for byte in range(0x80, 0xA0):
            table.setdefault(chr(byte), byte)
    return table


_TABLES = {enc: _table(enc) for chain in CHAINS for enc, _ in chain}


def _undo_run(run: str, wrong: str, true: str) -> str:
    """One step undone in a run of characters beyond ASCII, or the run itself where the step can't have happened."""
    table = _TABLES[wrong]
    if true != "utf-8":
        codes = [table.get(ch) for ch in run]
        if None in codes:
            return run
        out = bytes(codes).decode(true, "replace")
        return run if LOST in out else out
    if LOST in run:
        # what lies between lost characters may be cut anywhere: its whole sequences are restored
        return "".join(part if part == LOST or not part else _undo_part(part, table, True) for part in re.split(f"({LOST})", run))
    return _undo_part(run, table, False)


def _undo_part(part: str, table: dict[str, int], cut: bool) -> str:
    codes = [table.get(ch) for ch in part]
    if None in codes:
        return part
    raw = bytes(codes)
    if not cut:
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return part
    out, last = [], 0
    for m in _MULTI.finditer(raw):
        try:
            restored = m.group().decode("utf-8")
        except UnicodeDecodeError:
            continue
        out += [part[last : m.start()], restored]
        last = m.end()
    return "".join(out) + part[last:]


def undo(word: str, chain: int) -> str:
    for wrong, true in CHAINS[chain]:
        new = _RUN.sub(lambda m: _undo_run(m.group(), wrong, true), word)
        if new == word:
            return word
        word = new
    return word


def _klass(ch: str) -> str:
    """Letters of large alphabets share a class for each 128 code points, which bounds the score model."""
    code = ord(ch)
    return ch if code < 0x530 or 0x900 <= code < 0xE00 or 0x2000 <= code < 0x2300 else chr(code & ~0x7F)


def _words(text: str) -> Iterator[str]:
    """Words with a character beyond ASCII; only ASCII white space parts words, as garbled text may hold other blanks."""
    for word in _SPACED.findall(text):
        if not word.isascii():
            yield word


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adjacent characters in words with a character beyond ASCII that no multi-byte chain could have produced."""
    judged: dict[str, bool] = {}
    wide = [k for k, chain in enumerate(CHAINS) if len(chain) == 1 and chain[0][1] == "utf-8"]
    for batch in batches:
        words: Counter[str] = Counter()
        for text in batch["t"]:
            words.update(_words(text))
        pairs: Counter[str] = Counter()
        for word, n in words.items():
            if (sound := judged.get(word)) is None:
                sound = LOST not in word and all(undo(word, k) == word for k in wide)
                if len(judged) < 500_000:
                    judged[word] = sound
            if sound:
                w = " " + "".join(map(_klass, word)) + " "
                for a, b in zip(w, w[1:]):
                    pairs[a + b] += n
        yield pd.DataFrame(list(pairs.items()), columns=["pair", "n"])


def pair_counts(df: DataFrame, text: str) -> dict[str, int]:
    """Counts of adjacent characters over all texts: at most as many entries as pairs of letters in use, and at most ``MOST_PAIRS``."""
    counted = df.select(F.col(text).cast("string").alias("t")).where("t is not null").mapInPandas(_count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return {r["pair"]: r["n"] for r in counted.orderBy(F.desc("n"), "pair").limit(MOST_PAIRS).collect()}


class LineJudge:
    """Log-likelihood of a line under each chain; words are judged once and remembered."""

    def __init__(self, counts: dict[str, int]):
        first: Counter[str] = Counter()
        single: Counter[str] = Counter()
        for pair, n in counts.items():
            first[pair[0]] += n
            single[pair[1]] += n
        total = sum(single.values()) + 1
        self._single = {ch: math.log(0.1 * (n + 0.05) / total) for ch, n in single.items()}
        self._unseen = math.log(0.1 * 0.05 / total)
        self._pair = {p: math.log(0.9 * n / first[p[0]] + math.exp(self._single[p[1]])) for p, n in counts.items()}
        self._known: dict[str, tuple[float, dict[int, float]]] = {}

    def score(self, word: str) -> float:
        total, a = 0.0, " "
        for b in map(_klass, word):
            total += self._pair.get(a + b) or self._single.get(b, self._unseen)
            a = b
        return total + (self._pair.get(a + " ") or self._single.get(" ", self._unseen))

    def word(self, word: str) -> tuple[float, dict[int, float]]:
        """Score as it stands, and the gain in score of each chain that changes it."""
        if (known := self._known.get(word)) is None:
            if len(self._known) > 300_000:
                self._known.clear()
            sound, gains = self.score(word), {}
            for k in range(1, len(CHAINS)):
                new = undo(word, k)
                if new != word:
                    # kept apart with a negative key: here the second step has nothing to undo
                    alone = len(CHAINS[k]) > 1 and new == undo(word, _FIRST[k])
                    gains[-k if alone else k] = self.score(new) - sound
            known = self._known[word] = (sound, gains)
        return known

    def line(self, line: str) -> dict[int, float]:
        """Gain in log-likelihood over sound text, for each chain that changes the line."""
        gains: dict[int, float] = {}
        for word in _words(line):
            for k, g in self.word(word)[1].items():
                gains[k] = gains.get(k, 0.0) + g
        # a chain of two steps needs a word in which both took place
        return {k: g + gains.get(-k, 0.0) for k, g in gains.items() if k > 0}


    def undone(self, word: str, chain: int) -> str:
        """``word`` with ``chain`` undone, or as it is where another chain explains it far better."""
        if word.isascii():
            return word
        gains = self.word(word)[1]
        own = gains.get(chain, gains.get(-chain))
        return word if own is None or max(0.0, *gains.values()) - own > CLEARLY else undo(word, chain)


def _posterior(gains: dict[int, float], log_prior: list[float]) -> tuple[int, float]:
    """Chain with the highest posterior and the posterior that the line is garbled at all."""
    logs = {k: g + log_prior[k] - log_prior[0] for k, g in gains.items()}
    if not logs:
        return 0, 0.0
    top = max(max(logs.values()), 0.0)
    weights = {k: math.exp(v - top) for k, v in logs.items()}
    garbled = sum(weights.values())
    return min(weights, key=lambda k: (-weights[k], k)), garbled / (garbled + math.exp(-top))


def learn_priors(df: DataFrame, text: str, source: str, model) -> DataFrame:
    """Expectation-maximization of the share of each chain for each source: ``source, prior array<double>``."""

    def gains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = LineJudge(model.value)
        for batch in batches:
            rows = []
            for s, t in zip(batch["s"], batch["t"]):
                plain = 0
                for line in t.split("\n"):
                    if line.isascii():
                        continue
                    # a chain that is far less likely than sound text has no weight
                    g = {k: v for k, v in judge.line(line).items() if v > -3.0}
                    if g:
                        rows.append((s, 1, list(g), list(g.values())))
                    else:
                        plain += 1
                if plain:
                    rows.append((s, plain, [], []))
            yield pd.DataFrame(rows, columns=["s", "n", "k", "g"])

    lines = materialize(
        df.select(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("s"), F.col(text).cast("string").alias("t"))
        .where("t is not null")
        .mapInPandas(gains, "s string, n long, k array<int>, g array<double>"),
        "mojibake-lines",
    )
    total = lines.groupBy("s").agg(F.sum("n").cast("double").alias("total"))
    start = first_shares()
    prior = materialize(total.select("s", "total", F.array(*map(F.lit, start)).alias("prior")), "mojibake-prior")
    weak = lines.where(F.size("k") > 0)
    for _ in range(ROUNDS):
        weighted = (
            weak.join(bounded_broadcast(prior.select("s", "prior"), 100_000), "s")
            .withColumn("w", F.expr("transform(arrays_zip(k, g), x -> x.g + ln(prior[x.k]) - ln(prior[0]))"))
            .withColumn("top", F.greatest(F.array_max("w"), F.lit(0.0)))
            .withColumn("w", F.expr("transform(w, x -> exp(x - top))"))
            .withColumn("norm", F.expr("aggregate(w, exp(-top), (a, x) -> a + x)"))
            .select("s", F.explode(F.arrays_zip("k", "w")).alias("x"), "norm")
            .groupBy("s", F.col("x.k").alias("k"))
            .agg(F.sum(F.col("x.w") / F.col("norm")).alias("m"))
            .groupBy("s")
            .agg(F.map_from_entries(F.collect_list(F.struct("k", "m"))).alias("m"))
        )
        # smoothed by one pseudo-line with the first shares: no chain ever gets a share of 0
        shares = F.expr(f"transform(sequence(1, {len(CHAINS) - 1}), k -> (coalesce(m[k], 0D) + start[k]) / (total + 1))")
        prior = materialize(
            prior.withColumnRenamed("prior", "old")
            .join(weighted, "s", "left")
            .withColumn("start", F.array(*map(F.lit, start)))
            .withColumn("rest", shares)
            .select("s", "total", "old", F.concat(F.array(F.greatest(F.lit(0.01), 1 - F.expr("aggregate(rest, 0D, (a, x) -> a + x)"))), F.col("rest")).alias("prior"))
            .withColumn("moved", F.array_max(F.zip_with("old", "prior", lambda x, y: F.abs(x - y))))
            .drop("old"),
            "mojibake-prior",
        )
        if (prior.agg(F.max("moved")).first()[0] or 0.0) <= SETTLED:
            break
    return prior.select("s", "prior")


def repair(df: DataFrame, text: str, source: str, out: str = "repaired", flag: str = "garbled", chains: str = "chains") -> DataFrame:
    """Add the restored text, whether any part of the text is garbled, and the chains found.

    ``flag`` is true where a line's posterior for some wrong chain is at least 0.5, or the text holds a replacement character
    (U+FFFD) or a C1 control character: those can't be restored, but show the damage; their chain is named "lost". Lines without damage stay as they are, byte
    for byte.

    * A repaired line is judged again until no chain wins: parts damaged in different ways, or more than twice, are restored in turn.
    * A null text gives null, false and no chains; an empty text is sound. A null source is a source of its own.
    * Texts of any length are read whole. Repeated rows give repeated results. An empty table gives an empty one.
    * Existing columns named like the three results are replaced.
    """
    spark = df.sparkSession
    model = spark.sparkContext.broadcast(pair_counts(df, text))
    prior = learn_priors(df, text, source, model).select(F.col("s").alias("__kl_s"), F.col("prior").alias("__kl_prior"))

    @F.pandas_udf("repaired string, garbled boolean, chains string")
    def fix(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        judge = LineJudge(model.value)
        logs: dict[bytes, list[float]] = {}
        default = [math.log(x) for x in first_shares()]
        for texts, priors in batches:
            rows = []
            for t, p in zip(texts, priors):
                if t is None or t.isascii():
                    rows.append((t, False, ""))
                    continue
                if p is None:
                    log_prior = default
                elif (log_prior := logs.get(key := p.tobytes())) is None:
                    log_prior = logs[key] = [math.log(x) for x in p]
                lines, found = t.split("\n"), set()
                for n, line in enumerate(lines):
                    # a line damaged in several ways, or more than twice, is judged again as repaired so far
                    seen = {line}
                    while not line.isascii():
                        best, garbled = _posterior(judge.line(line), log_prior)
                        if garbled < LEAST:
                            break
                        found.add(NAMES[best])
                        line = _SPACED.sub(lambda m: judge.undone(m.group(), best), line)
                        if line in seen:
                            break
                        seen.add(line)
                    lines[n] = line
                restored = "\n".join(lines) if found else t
                if LOST in t or _C1.search(t):
                    found.add(DESTROYED)
                rows.append((restored, bool(found), ", ".join(sorted(found))))
            yield pd.DataFrame(rows, columns=["repaired", "garbled", "chains"])

    kept = [c for c in df.columns if c not in (out, flag, chains)]
    return (
        df.withColumn("__kl_s", F.coalesce(F.col(source).cast("string"), F.lit("")))
        .join(bounded_broadcast(prior, 100_000), "__kl_s", "left")
        .withColumn("__kl_fix", fix(F.col(text).cast("string"), F.col("__kl_prior")))
        .select(*kept, F.col("__kl_fix.repaired").alias(out), F.col("__kl_fix.garbled").alias(flag), F.col("__kl_fix.chains").alias(chains))
    )
