"""The pipeline, stage by stage, against brute force on the smallest tables; the registry."""

import os

import pytest
from tokenizers import Tokenizer
import public_tokenizers as P

import corpus_pipeline as C
from dialstat.llm.registry import QUERIES
from dialstat.llm.staging import release, stage
from conftest import SF
from odd import SCHEMA, odd_documents, rows_of, words
from test_decontaminate import expected as hits
from test_jaccard_join import components, sets_of
from test_quality_rules import base_failed, statistics

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in rows_of(spark.read.parquet(f"{SF}/benchmark.parquet"))]
    state = {r["doc_id"]: r for r in rows_of(docs)}
    for k, (name, function) in enumerate(C.STAGES):
        out = stage(function(spark, docs, SF), "test-stage")
        if k < len(C.STAGES) - 1:
            assert out.dtypes == docs.dtypes
        got = {r["doc_id"]: r for r in rows_of(out)}
        assert len(got) == out.count()
        before, ids = state, list(state)
        if name == "quality rules":
            stats = {i: statistics(state[i]["text"]) for i in ids}
            junk = lambda s: s["n_symbols"] > 0.05 * s["word_chars"]
            want = {i for i in ids if not base_failed(stats[i]) and not junk(stats[i])}
        elif name == "language id":
            want = set(ids)  # every document is prose in a learned language
        elif name == "n-gram jaccard join":
            roots = components(sets_of([state[i]["text"] for i in ids], 5), 80, 100)
            want = {min(i for i, r in zip(ids, roots) if r == root) for root in roots}
        elif name == "benchmark decontamination":
            found = hits([(i, state[i]["text"]) for i in ids], items)
            want = {i for i, f in zip(ids, found) if not f[3]}
        else:
            want = set(ids)
        assert set(got) == want, name
        if k < len(C.STAGES) - 1:
            assert all(got[i] == before[i] for i in want)
            assert len(want) < len(ids) or name == "language id"
            state, docs = got, out
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for i, r in got.items():
        assert r["ids"] == library.encode(state[i]["text"], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])
    assert rows_of(C.run(spark, SF).select("doc_id", "n_tokens").orderBy("doc_id")) == [
        {"doc_id": i, "n_tokens": got[i]["n_tokens"]} for i in sorted(got)
    ]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables_pass_every_stage(spark, odd, nothing, empty):
    docs = nothing if empty else odd
    for _, function in C.STAGES[:-1]:
        docs = stage(function(spark, docs, SF), "odd-stage")
        assert docs.columns == odd.columns
    assert C.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    if not empty:
        gone = C.without(odd, odd.filter("doc_id IS NULL OR doc_id = 15"))
        assert sorted(r["doc_id"] for r in rows_of(gone)) == sorted(r[0] for r in odd_documents() if r[0] not in (None, 15))


def repeated_documents():
    """Groups of copies and near copies with repeated and null ids, and rows like no other."""
    texts = [words(120, k) for k in range(50, 57)]
    near = texts[0] + " and more"
    rows = [(7, texts[0]), (7, texts[0]), (3, near), (None, texts[0]), (None, near), (3, near)]
    rows += [(None, texts[1]), (None, texts[1]), (None, texts[1] + " end")]  # no id at all
    rows += [(9, texts[2]), (9, texts[3]), (9, texts[3])]  # one id, two texts
    rows += [(None, texts[4]), (5, texts[4]), (None, texts[5]), (11, texts[6]), (12, None), (12, None), (None, "")]
    return [(i, t, "en", "a", None if t is None else len(t), "n", 0, k, "l", 1, "w") for k, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("written", [False, True])
def test_one_row_of_each_group_stays(spark, written):
    rows = repeated_documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs = stage(docs, "repeated") if written else docs
    got = rows_of(stage(C.near_duplicates(spark, docs, SF), "kept"))
    sets = sets_of([r[1] for r in rows], 5)
    roots = components(sets, 80, 100)
    groups = {}
    for k, (r, root) in enumerate(zip(rows, roots)):
        groups.setdefault(root if sets[k] else ("alone", k), []).append(r[0])
    want = [min(ids, key=lambda i: (i is None, i or 0)) for ids in groups.values()]
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(map(str, want))
    # every row that stays is an input row, and no two of a group stay
    by_row = {r[7]: roots[k] if sets[k] else ("alone", k) for k, r in enumerate(rows)}
    assert len({by_row[r["row"]] for r in got}) == len(got) == len(groups)


def test_a_row_that_goes_takes_no_other_row_of_its_id(spark):
    """Clean rows without ids or with the id of a bad row stay in each of the filter stages."""
    (item,) = {r["text"] for r in rows_of(spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(1))}
    filtered = [(C.quality_rules, "too short"), (C.language_id, "12 34 !?"), (C.benchmark_decontamination, item)]
    for function, bad in filtered:
        rows = [(i, t) for i in (None, 4, 5) for t in (words(80, 60 + (i or 0)), bad)] + [(k, words(80, k)) for k in range(70, 90)]
        docs = spark.createDataFrame(
            [(i, t, "en", "a", len(t), "n", 0, k, "l", 1, "w") for k, (i, t) in enumerate(rows)], SCHEMA
        ).repartition(3)
        got = sorted(r["row"] for r in rows_of(stage(function(spark, docs, SF), "by-row")))
        assert got == [k for k, (_, t) in enumerate(rows) if t != bad], function.__name__


def test_documents_stay_when_no_language_can_be_learned(spark, odd):
    unlabelled = odd.withColumn("lang", C.F.lit(None).cast("string"))
    got = rows_of(C.language_id(spark, unlabelled, SF))
    want = [r[1] for r in odd_documents() if any(map(str.isalpha, r[1] or ""))]
    assert sorted(r["text"] for r in got) == sorted(want)


def test_columns_of_any_name_pass(spark):
    """Names that stages use for themselves are no clash in the input."""
    names = ["row_number", "row_number_", "component_id", "carried_0", "kept", "lang_pred", "score", "sets", "hits", "row", "gone_key", "pipeline_row"]
    rows = [(k, words(80, 200 + k), "en", "a") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({n: C.F.lit(i) for i, n in enumerate(names)})
    for _, function in C.STAGES[:-1]:
        docs = stage(function(spark, docs, SF), "names")
        assert docs.columns == ["doc_id", "text", "lang", "source", *names]
    assert sorted(tuple(r)[:2] for r in docs.collect()) == [r[:2] for r in rows]
    assert {tuple(r)[4:] for r in docs.collect()} == {tuple(range(len(names)))}


def test_texts_are_shuffled_by_the_duplicate_stage_only(spark, documents, monkeypatch):
    """With nothing small enough to be broadcast by Spark, no exchange of the other stages has the text."""
    import re

    from dialstat.llm import staging

    plans = []
    written = staging.stage

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name)

    for module in ("quality", "decontaminate", "language_id", "jaccard_join", "components"):
        m = __import__(f"dialstat.llm.{module}", fromlist=["x"])
        if hasattr(m, "stage"):
            monkeypatch.setattr(m, "stage", watched)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.maxMetadataStringLength")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        for name, function in C.STAGES[:-1]:
            if name == "n-gram jaccard join":
                continue
            watched(function(spark, docs, SF), name)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name, plan in plans:
        tree = plan.split("\n")
        for i, line in enumerate(tree):
            if "Exchange " in line:
                # what an exchange moves is the output of the operator below it
                below = next((x for x in tree[i + 1 :] if "Project [" in x or "HashAggregate(" in x or "Sort" not in x), "")
                assert not re.search(r"\btext#|carried_1#", below), (name, line, below)
    assert len(plans) > 5


def test_registry_names_every_operator():
    assert sorted(int(name[2 : name.index("_")]) for name in QUERIES) == list(range(1, 14))
    assert {n for n, (_, sql) in QUERIES.items() if sql} >= {"op1_jaccard_join", "op2_sharding", "op3_warc", "op8_decontaminate"}
    assert len(C.STAGES) == 5 and SCHEMA


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_queries_match_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    function, sql = QUERIES[name]
    got = function(spark, SF)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r[c] for c in columns) for r in got.collect()) == order(result.fetchall())


def test_release_deletes_staged_tables(spark):
    table = stage(spark.range(3), "to-go")
    (path,) = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    assert release(spark) >= 1 and not os.path.exists(path.removeprefix("file://").removeprefix("file:"))
