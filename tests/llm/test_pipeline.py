import public_tokenizers
from test_ngram_join import word_sets
from test_packing import check
from test_sanitise import masked, term_actions

import corpus_pipeline
from blotter.llm.common import collapse_white
from blotter.llm.exact_dedup import drop_exact_duplicates
from blotter.llm.labels import fold
from blotter.llm.line_crf import fit, score_quality
from blotter.llm.ngram_join import keep_one_per_component
from blotter.llm.sanitise import sanitise


def linked(rows):
    sets = {d: word_sets(t, 5) for d, t in rows}
    up = {d: d for d, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return [(d, t) for d, t in rows if find(d) == d]


def test_stages_against_brute_force(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name))
        if name == "quality":
            good = {r.doc_id for r in score_quality(docs, fit(docs, labels, fold("doc_id", 5) != 0)).collect()
                    if r.score >= 0.3}
            rows = [r for r in rows if r[0] in good]
        elif name == "exact_dedup":
            first = {}
            for d, t in sorted(rows):
                first.setdefault(collapse_white(t.encode()), (d, t))
            rows = list(first.values())
        elif name == "ngram_join":
            rows = linked(rows)
        elif name == "sanitise":
            actions = term_actions([t for _, t in rows])
            assert any(actions.values())
            rows = [(d, masked(t, actions[t])) for d, t in rows]
        if k < len(corpus_pipeline.STAGES) - 1:
            assert got.columns == columns
            assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(rows)
            assert got.filter("n_chars <> length(text)").count() == 0
        else:
            assert check(rows, got.collect()) > 0.9
        docs = got
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_stages_take_columns_of_any_name(spark):
    """Names that the stages use themselves, and repeated rows: columns and row counts stay defined."""
    text = "The and of a line of plain words from a.b@c.de. " * 5
    names = ["_sha", "_row", "_kept_id", "_kept_sha", "_keep", "_cuts", "_id", "_loc"]
    rows = [(d, t, *range(8)) for d, t in [(1, text), (1, text), (2, "other words entirely"), (None, None), (3, text + "x")]]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    for stage, count in ((drop_exact_duplicates, 4), (keep_one_per_component, 4), (sanitise, 5)):
        out = stage(df)
        assert out.columns == df.columns and out.count() == count


def test_empty_and_odd_rows(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    schema = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    text = "The and of a line of plain words. Here is one more. " * 5
    odd = spark.createDataFrame([(1, None, None, None, None), (None, text, "en", "s", 5), (2, "", "en", "s", 0),
                                 (3, text, "en", "s", 5), (3, text, "en", "s", 5)], schema)
    for name, rows in (("empty", spark.createDataFrame([], schema)), ("odd", odd)):
        docs = rows
        for k, (stage_name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name / stage_name))
            docs = spark.read.parquet(str(tmp_path / name / stage_name))
        assert (docs.count() > 0) == (name == "odd")
