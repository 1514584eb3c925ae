"""Word lists and patterns of business names and addresses. Results depend on them."""

LEGAL_FORMS = (
    "llc", "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "pvt", "private", "llp", "lp", "pc", "plc", "pllc",
    "sarl", "sas", "sasu", "eurl", "sa", "sci", "snc", "cie", "gmbh", "praivet",
)
FILLERS = ("center", "centre", "services", "service", "group", "and", "the", "of", "fka", "aka", "dba")
HONORIFICS = ("shri", "sri", "smt", "mr", "mrs", "dr", "md", "dmd")
NAME_STOP = (*LEGAL_FORMS, *FILLERS, *HONORIFICS)
NAME_STOP_PHRASES = ("l l c", "p c", "f k a", "a k a", "m d", "pra li")

#: Whole address tokens and what they stand for, by country of origin.
ADDRESS_WORDS = {
    "st": "street", "rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "ct": "court", "cir": "circle",
    "pl": "place", "pkwy": "parkway", "hwy": "highway", "trl": "trail", "ter": "terrace", "sq": "square", "n": "north", "s": "south", "e": "east",
    "w": "west", "ste": "suite", "apt": "apartment", "so": "south",
    "no": "number", "h": "house", "hno": "house", "nr": "near", "opp": "opposite", "flr": "floor", "blk": "block", "sec": "sector", "mg": "marg",
    "r": "rue", "bd": "boulevard", "all": "allee", "imp": "impasse", "che": "chemin", "rte": "route", "fbg": "faubourg",
}

DOMAIN_ENDINGS = ("com", "in", "org", "net", "co", "fr")

#: Expected aliases for the sanity list: (variant, canonical).
EXPECTED_ALIASES = (("mh", "maharashtra"), ("mharastr", "maharashtra"), ("tx", "texas"), ("texas", "tx"), ("krnatk", "karnataka"), ("dl", "delhi"))

# Defaults of the tunables.
SEED, N_SHARDS, VAL_MOD = 42, 16, 5
BLOCK_CAP, PREFILTER_K, TOP_K = 1000, 200, 50
ALIAS_SAMPLE, ALIAS_MIN_COUNT, ALIAS_MIN_SHARE, ALIAS_LAST_SHARE = 300_000, 50, 0.8, 0.8
RECALL_KS = (10, 20, 30, 50)
THRESHOLDS = tuple(round(0.05 + 0.01 * i, 6) for i in range(91))
KEY_BITS = {"K1": 1, "K2": 2, "K3": 4, "K4": 8}
