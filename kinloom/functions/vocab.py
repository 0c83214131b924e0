"""Word lists of the domain: fixed values, each in natural order."""

from __future__ import annotations

#: State names and their codes.
US_STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct",
    "delaware": "de", "district of columbia": "dc", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il",
    "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md",
    "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt",
    "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny",
    "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa",
    "rhode island": "ri", "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut",
    "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
}
#: Indian states, with spellings that romanised native script gives.
IN_STATES = {
    "andhra pradesh": "ap", "arunachal pradesh": "ar", "assam": "as", "bihar": "br", "chandigarh": "ch", "chhattisgarh": "cg",
    "delhi": "dl", "goa": "ga", "gujarat": "gj", "haryana": "hr", "himachal pradesh": "hp", "jammu and kashmir": "jk",
    "jharkhand": "jh", "karnataka": "ka", "kerala": "kl", "madhya pradesh": "mp", "maharashtra": "mh", "manipur": "mn",
    "meghalaya": "ml", "mizoram": "mz", "nagaland": "nl", "odisha": "od", "orissa": "od", "puducherry": "py", "punjab": "pb",
    "rajasthan": "rj", "sikkim": "sk", "tamil nadu": "tn", "telangana": "tg", "tripura": "tr", "uttar pradesh": "up",
    "uttarakhand": "uk", "west bengal": "wb",
    "andhr pradesh": "ap", "dilli": "dl", "gujrat": "gj", "hariyana": "hr", "karnatak": "ka", "keral": "kl",
    "nct of delhi": "dl", "pondicherry": "py", "uttaranchal": "uk", "pashchim bangal": "wb", "madhy pradesh": "mp", "maharashtr": "mh", "panjab": "pb", "tamilnadu": "tn", "telangan": "tg", "ts": "tg",
}
STATE_CODES = {**IN_STATES, **{code: code for code in IN_STATES.values()}, **US_STATES, **{code: code for code in US_STATES.values()}}

#: Short forms of words in addresses.
ADDRESS_SHORT = {
    "allee": "all", "av": "ave", "avenue": "ave", "bd": "blvd", "bengaluru": "bangalore", "bombay": "mumbai", "boulevard": "blvd",
    "bvd": "blvd", "chemin": "ch", "circle": "cir", "colony": "col", "county": "cnty", "court": "ct", "cross": "crs", "cty": "cnty",
    "drive": "dr", "east": "e", "expressway": "expy", "ext": "extn", "extension": "extn", "fort": "ft", "ftt": "ft",
    "gurugram": "gurgaon", "highway": "hwy", "impasse": "imp", "lane": "ln", "layout": "lyt", "mount": "mt", "mtt": "mt",
    "nagar": "ngr", "ngar": "ngr", "north": "n", "parkway": "pkwy", "phase": "ph", "place": "pl", "r": "rue", "road": "rd",
    "route": "rte", "rue": "rue", "saint": "st", "sector": "sec", "south": "s", "square": "sq", "str": "st", "street": "st",
    "terrace": "ter", "township": "twp", "trail": "trl", "twnship": "twp", "west": "w",
}
#: Words that only announce a number or a part of a building.
DESIGNATORS = (
    "no", "nos", "h", "hno", "house", "door", "dno", "plot", "flat", "unit", "apt", "apartment", "suite", "ste", "office", "level",
    "floor", "fl", "bldg", "building", "shop", "po", "box", "near", "opp", "behind", "c", "o", "s", "at",
)
#: Legal forms and designations to one short form.
LEGAL_FORMS = {
    "private": "pvt", "pvt": "pvt", "pvte": "pvt", "prvt": "pvt", "prv": "pvt", "prvhte": "pvt", "praivet": "pvt", "praivat": "pvt",
    "pra": "pvt", "piraivet": "pvt", "limited": "ltd", "ltd": "ltd", "limitad": "ltd", "limitd": "ltd", "limitet": "ltd", "li": "ltd",
    "llp": "llp", "elelpi": "llp", "elaelpi": "llp", "opc": "opc", "llc": "llc", "lc": "llc", "inc": "inc", "incorporated": "inc", "corp": "corp",
    "corporation": "corp", "co": "co", "company": "co", "kampani": "co", "plc": "plc", "lp": "lp", "pllc": "pllc", "pc": "pc",
    "pa": "pa", "esq": "esq", "dc": "dc", "dpm": "dpm", "md": "md", "dds": "dds", "cpa": "cpa", "sarl": "sarl", "sas": "sas",
    "sasu": "sasu", "sa": "sa", "sci": "sci", "eurl": "eurl", "snc": "snc", "scp": "scp", "selarl": "selarl", "scop": "scop",
}
#: Words without weight in a name.
NAME_STOPWORDS = ("and", "the", "of", "et", "de", "du", "des", "la", "le", "les", "a")
