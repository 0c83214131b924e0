"""Settings, path catalogue and named presets."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

SEED = 42
KEY_TYPES = ("N", "P", "A", "U", "W", "C", "B", "M", "T")
NAME_KEY_TYPES = ("N", "P", "C", "T")
#: Weight of each key type and the largest block that counts.
KEY_WEIGHTS = {"N": 1.0, "P": 1.5, "A": 2.0, "U": 2.0, "W": 1.0, "C": 2.0, "B": 2.0, "M": 2.0, "T": 2.5}
CAPS = {"N": 300, "P": 500, "A": 500, "U": 500, "W": 200, "C": 300, "B": 500, "M": 500, "T": 500}


@dataclass(frozen=True)
class Paths:
    """Where the pipeline reads and writes; each from an environment variable or given."""

    data: str = field(default_factory=lambda: os.environ.get("KINLOOM_DATA_DIR", "data"))
    work: str = field(default_factory=lambda: os.environ.get("KINLOOM_WORK_DIR", "work"))
    output: str = field(default_factory=lambda: os.environ.get("KINLOOM_OUTPUT_DIR", "output"))

    def sources(self, split: str) -> dict[str, str]:
        return {f"s{n}": f"{self.data}/{split}_source{n}.tsv" for n in (1, 2, 3)}

    @property
    def ground_truth(self) -> str:
        return f"{self.data}/train_ground_truth.tsv"


@dataclass(frozen=True)
class Blocking:
    """How candidate pairs are retrieved and selected.

    ``select``: none (best by block score), combo, union, union3, rscore. ``k_b, k_r, k_n``: of union3. ``reverse_k``: best clean records
    that each pool record proposes (0: none).
    """

    caps: dict[str, int] = field(default_factory=lambda: dict(CAPS))
    weight: str = "inv"
    retrieve_k: int = 50
    name_retrieve_k: int = 0
    final_k: int = 16
    select: str = "union"
    k_b: int = 0
    k_r: int = 0
    k_n: int = 0
    reverse_k: int = 0
    reverse_min_rscore: float = 0.0
    reverse_min_nscore: float = 2.0

    @property
    def largest_cap(self) -> int:
        return max(self.caps.values())


def _three(k_b: int, k_r: int, k_n: int, **more) -> Blocking:
    return Blocking(select="union3", final_k=0, k_b=k_b, k_r=k_r, k_n=k_n, **more)


_V16 = _three(8, 8, 5, retrieve_k=80, name_retrieve_k=30, caps={**CAPS, "C": 1000, "T": 1000})
#: The named configurations.
PRESETS: dict[str, Blocking] = {
    "v6": Blocking(caps={**CAPS, "T": 0}),
    "v8": Blocking(),
    "v9": _three(8, 8, 4),
    "v10": _three(8, 8, 4, retrieve_k=80),
    "v11": _three(6, 6, 4, retrieve_k=80),
    "v12": _three(8, 8, 8, retrieve_k=80),
    "v13": _three(5, 5, 3, retrieve_k=80),
    "v14": _three(8, 8, 4, retrieve_k=80, name_retrieve_k=20),
    "v15": _three(7, 7, 5, retrieve_k=80, name_retrieve_k=20),
    "v16": _V16,
    "v17": replace(_V16, reverse_k=2, reverse_min_rscore=1.0, reverse_min_nscore=0.85),
    "v18": replace(_V16, reverse_k=3, reverse_min_rscore=0.8, reverse_min_nscore=0.85),
    "v19": replace(_V16, reverse_k=2, reverse_min_rscore=0.6, reverse_min_nscore=0.85),
}
