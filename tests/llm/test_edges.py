"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns: no crash and defined results."""

import pytest

from linkmill.llm import audio, decontaminate, jaccard_join, licenses, packing, quality, secret_scan, sharding, token_counts, toxicity

OPERATORS = {
    "toxicity": lambda d, l, b: toxicity.toxicity_scores(d, toxicity.train(d, l)),
    "sharding": lambda d, l, b: sharding.histogram_shards(d),
    "token_counts": lambda d, l, b: token_counts.token_counts(d),
    "prefix_tables": lambda d, l, b: token_counts.prefix_tables(d),
    "truncated": lambda d, l, b: token_counts.truncated(d, 5),
    "audio": lambda d, l, b: audio.audio_columns(d),
    "quality": lambda d, l, b: quality.quality_scores(d, quality.train(d, l)),
    "licenses": lambda d, l, b: licenses.license_scan(d),
    "secrets": lambda d, l, b: secret_scan.secret_scan(d),
    "jaccard": lambda d, l, b: jaccard_join.jaccard_components(d),
    "decontaminate": lambda d, l, b: decontaminate.contamination(d, b),
}


def plain(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_once_and_other_columns_unread(name, nasty, clashing, labels, benchmark):
    result = OPERATORS[name](nasty, labels, benchmark)
    got = result.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in nasty.select("doc_id").collect())
    assert plain(OPERATORS[name](clashing, labels, benchmark)) == sorted(map(str, got))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, empty, labels, benchmark):
    assert OPERATORS[name](empty, labels, benchmark).collect() == []


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("sharding",)])
def test_repeated_rows_get_equal_results(name, nasty, labels, benchmark):
    got = [r for r in OPERATORS[name](nasty, labels, benchmark).collect() if r.doc_id == 5]
    assert len(got) == 2 and got[0] == got[1]


def test_packing_edges(nasty, empty, clashing):
    assert packing.pack(empty).collect() == []
    got = packing.pack(nasty).collect()
    assert plain(packing.pack(clashing)) == sorted(map(str, got))
    assert {str(r.doc_id) for r in got} == {str(r.doc_id) for r in nasty.select("doc_id").collect()}


def test_no_labels_or_benchmark(nasty, labels, benchmark):
    none = labels.where("false")
    assert {r.predicted for r in OPERATORS["quality"](nasty, none, None).collect()} == {1}
    assert len({r.score for r in OPERATORS["toxicity"](nasty, none, None).collect()}) == 1
    assert all(r.spans == [] for r in decontaminate.contamination(nasty, benchmark.where("false")).collect())
