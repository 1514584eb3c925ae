import unicodedata

import pytest
from pyspark.sql import functions as F

from linkmill.functions import text as T
from linkmill.operators.aliases import as_dict, learn, sanity
from linkmill.operators.normalize import COLUMNS, normalize

NAMES = [  # raw, name_core, name_nospace (or None), url
    ("Kochar Góld Private", "kochar gold", None, 0),
    ("lifeinvestments.com", "lifeinvestments", "lifeinvestments", 1),
    ("Life Investments", "life investments", "lifeinvestments", 0),
    ("#empiremolecular", "empiremolecular", None, 0),
    ("Empire Molecular Inc.", "empire molecular", "empiremolecular", 0),
    ("Summit Society L.L.C.", "summit society", None, 0),
    ("-- Holloway Peak Inc Seafood | www.hollowaypeak.com", "holloway peak seafood", None, 1),
    ("Shri Kochar Kochar Traders", "kochar traders", None, 0),
    ("The Company", "the company", None, 0),
    ("जय एंटरप्राइजेज प्राइवेट लिमिटेड", "jy emtrpraijej", None, 0),
    ("गुरु बिजनेस प्रा. लि.", "guru bijnes", None, 0),
    ("Bangalore. Sanghi-Ltd.", "bangalore sanghi", None, 0),
    ("Butterfly Power Limited Center", "butterfly power", None, 0),
    ("", "", "", 0),
    (None, "", "", 0),
]
ALIASES = {"texas": "tx", "tx": "tx", "west bengal": "wb", "de": "de", "la": "la", "mh": "maharashtra"}
ADDRESSES = [  # raw, norm, core, numbers, first, admin
    ("00272 LAGO GRANDE DRIVE", "272 lago grande drive", "272 lago grande drive", "272", "272", ""),
    ("41 BIRCH HILL DR", "41 birch hill drive", "41 birch hill drive", "41", "41", ""),
    ("NULL, 12 Main Road, null", "12 main road", "12 main road", "12", "12", ""),
    ("NULL", "", "", "", "", ""),
    ("", "", "", "", "", ""),
    (None, "", "", "", "", ""),
    ("105 Elm St, Ste 200", "105 elm street suite 200", "105 elm street suite 200", "105 200", "105", ""),
    ("15 St Michel", "15 street michel", "15 street michel", "15", "15", ""),
    ("KH NO. -570/13, 1000 34-1002", "kh number 570 13 1000 34 1002", "kh number 570 13 1000 34 1002", "570 13 1000 34 1002", "570", ""),
    ("155C Sullivant Dr, Unit 106, Marysville, Ohio", "155c sullivant drive unit 106 marysville ohio", "155c sullivant drive unit 106 marysville ohio", "155 106", "155", ""),
    ("6B/79- Mukundapur Road", "6b 79 mukundapur road", "6b 79 mukundapur road", "6 79", "6", ""),
    ("Mack Rd, Haltom City, Texas", "mack road haltom city texas", "mack road haltom city", "", "", "tx"),
    ("Mack Rd, TX 75001", "mack road tx 75001", "mack road 75001", "75001", "75001", "tx"),
    ("12 Rue de la Paix, Pune, MH", "12 rue de la paix pune mh", "12 rue de la paix pune", "12", "12", "maharashtra"),
    ("12 Rue de la Paix, Lille, Hauts-de-France", "12 rue de la paix lille hauts de france", "12 rue de la paix lille hauts de france", "12", "12", ""),
    ("3 C St, Austin, Texas", "3 c street austin texas", "3 c street austin", "3", "3", "tx"),
    ("000 Main", "0 main", "0 main", "0", "0", ""),
]


def frame(spark, names, addresses):
    n = max(len(names), len(addresses))
    rows = [(f"S1-{i}", 1, "US", names[i] if i < len(names) else "", addresses[i] if i < len(addresses) else "") for i in range(n)]
    return spark.createDataFrame(rows, "entity_id string, source int, country string, business_name string, business_address string")


def test_names(spark):
    got = normalize(frame(spark, [x[0] for x in NAMES], [])).orderBy(F.expr("int(substr(entity_id, 4))")).collect()
    for r, (raw, core, nospace, url) in zip(got, NAMES, strict=True):
        assert (r.name_core, r.name_has_url) == (core, url), raw
        if nospace is not None:
            assert r.name_nospace == nospace
    flags = {r.entity_id: r.name_nonlatin for r in got}
    assert flags["S1-9"] == flags["S1-10"] == 1 and flags["S1-0"] == flags["S1-1"] == 0


def test_clean(spark):
    df = spark.createDataFrame([("  Àmicale & Pàrenthese--Co.  ",), ("Straße Œuvre Ægir Ørsted",), ("日本 x",), ("",)], "t string")
    assert [r[0] for r in df.select(T.basic_clean(F.col("t"))).collect()] == ["amicale and parenthese co", "strasse oeuvre aegir orsted", "x", ""]


def test_other_scripts(spark):
    texts = {
        "Москва Щука": "moskva shchuka", "Αθήνα": "athina", "রাম": "ram", "राम": "ram", "ராம": "ram", "ગુજરાત": "gujrat",
        "राम Москва": "ram moskva", "東京 a": "a",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(T.basic_clean(F.col("t"))).collect()] == list(texts.values())


def test_nonlatin_goes_by_names_of_letters(spark):
    texts = {"Àmicale Góld": 0, "ａｂｃ": 1, "1ª": 1, "राम": 1, "Я": 1, "ﬁ": 0, "東": 1, "é 12!": 0, "": 0}
    plain = [int(any(c.isalpha() and not unicodedata.name(c, "").startswith("LATIN") for c in t)) for t in texts]
    assert plain == list(texts.values())
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(T.nonlatin("t")).collect()] == plain


def test_addresses(spark):
    df = normalize(frame(spark, [], [x[0] for x in ADDRESSES]), ALIASES)
    assert tuple(df.columns) == COLUMNS
    for r in df.collect():
        raw, norm, core, nums, first, admin = ADDRESSES[int(r.entity_id[3:])]
        assert (r.addr_norm, r.addr_core, r.addr_nums, r.addr_first_num, r.addr_admin, r.addr_empty) == (norm, core, nums, first, admin, int(norm == "")), raw


@pytest.mark.parametrize("raw,want", [("KH NO. -570/13, NEW DELHI, WEST DELHI, Delhi", ["west delhi", "delhi"]), ("Mack Rd, , Texas", ["mack rd", "texas"]), ("", []), ("x", ["x"])])
def test_tail_parts(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "a string").select(T.tail_parts("a")).first()[0] == want


def test_aliases(spark):
    pairs = [("India", "1 A, Mumbai, Maharashtra", "1 A, Mumbai, MH")] * 60 + [("India", "2 B, Pune, Maharashtra", "2 B, Pune City, Maharashtra")] * 60 + [("US", "3 C, Austin, TX", "3 C, Austin, Texas")] * 60
    df = spark.createDataFrame(pairs, "country string, addr_s1 string, addr_other string")
    learned = learn(df)
    assert as_dict(learned) == {"maharashtra": "maharashtra", "mh": "maharashtra", "texas": "tx", "tx": "tx"}
    by = {r.variant: r for r in learned.collect()}
    assert (by["mh"].country, by["mh"]["count"], by["mh"].occurrences) == ("India", 60, 60)
    assert {r.variant: r.ok for r in sanity(learned).collect()} == {"mh": True, "mharastr": False, "tx": False, "texas": True, "krnatk": False, "dl": False}
    assert learn(df.where("country = 'US'").limit(49)).count() == 0
