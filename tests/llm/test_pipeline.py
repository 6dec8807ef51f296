import pytest

import corpus_pipeline as cp
from lakeproof.llm import line_dedup, ngram_join
from lakeproof.llm.common import stored

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def test_filters_keep_whole_rows_and_most_good_ones(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0")
    for before, after in (stages[:2], stages[1:3]):
        assert after.columns == list(cp.COLUMNS)
        assert after.exceptAll(before).count() == 0
        good = before.where("size(split(text, ' ')) >= 60").join(labels.where("quality = 1"), "doc_id")
        assert after.join(good, "doc_id").count() >= 0.97 * good.count()
    assert stages[2].count() < stages[0].count()
    bad = labels.where("quality = 0")
    assert stages[2].join(bad, "doc_id").count() < 0.1 * stages[0].join(bad, "doc_id").count()


def test_line_dedup_leaves_no_repeated_block(spark, stages):
    after = stages[3]
    assert after.columns == list(cp.COLUMNS)
    assert after.where("n_chars <> length(text)").count() == 0
    again = line_dedup.dedup_lines(after)
    assert again.where("n_deleted > 0").count() <= 0.005 * after.count()
    whole = {r.doc_id: r.text for r in stages[2].collect()}
    for r in after.collect():
        lines = iter(whole[r.doc_id].split("\n"))
        assert all(line in lines for line in r.text.split("\n"))    # what stays keeps its order


def test_near_duplicates_and_packing(spark, stages):
    after = stages[4]
    assert after.exceptAll(stages[3]).count() == 0
    linked = ngram_join.link_documents(after)
    assert linked.where("component_id <> doc_id").count() == 0
    packed = stages[5]
    assert packed.select("doc_id").distinct().count() == after.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


def test_run(spark, stages):
    got = cp.run(spark, SF)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert got.select(*columns).exceptAll(stages[5].select(*columns)).count() == 0
    assert got.count() == stages[5].count()


def test_edges(spark, edge):
    docs = edge.selectExpr("doc_id", "text", "cast(null as string) as lang", "cast(null as string) as source",
                           "cast(length(text) as long) as n_chars")
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() <= docs.count() or name == cp.STAGES[-1][0]
        assert stage(spark, docs.limit(0), SF).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_more_python_workers_than_one_a_task(spark):
    """Each task of the line dedup cuts its texts once; the packing's table of slots needs no worker."""
    rows = [(i, f"a passage of eight words or more, the same\n{'only here ' * i}", "en", "x", 9) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cleaned = cp.dedup_lines(spark, docs, "")
    assert plan_of(cleaned).count("ArrowEvalPython") == 1
    assert {r.doc_id: r.text for r in cleaned.collect()} == {
        0: rows[0][1], **{i: "only here " * i for i in range(1, 5)}}
    assert "ExistingRDD" not in plan_of(cp.pack(spark, cleaned, ""))


def kept_by(monkeypatch, module):
    """What ``module`` stores, by label."""
    kept = {}

    def keep(df, label, *more):
        kept[label] = stored(df, label, *more)
        return kept[label]
    monkeypatch.setattr(module, "stored", keep)
    return kept


def test_quality_stages_store_no_texts(spark, monkeypatch):
    """Disk holds the counts of texts, not a copy of them; a task counts them in one Python worker."""
    kept = kept_by(monkeypatch, cp)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES[:2]:
        assert plan_of(stage(spark, docs, SF)).count("ArrowEvalPython") == 1
    assert set(kept) == {"quality", "rules"}
    for df in kept.values():
        assert "text" not in df.columns and df.count() == docs.count()


def test_only_documents_that_go_or_repeat_are_looked_up(spark, monkeypatch):
    """Of single documents no text is shuffled to find out that they stay."""
    kept = kept_by(monkeypatch, ngram_join)
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(30)), "x") for i in range(40)]
    rows += [(50, rows[3][1], "x"), rows[7], (None, rows[9][1], "x"), (60, None, "x"), (60, None, "x"), (61, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = ngram_join.without_near_duplicates(df)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [*rows[:40], *rows[43:]]))
    assert sorted((r.doc_id or -1, r.stays) for r in kept["marks"].collect()) == [(-1, False), (7, True), (50, False)]


def test_lists_of_lines_are_joined_alike_at_every_size(spark):
    rows = [(i, f"a passage of eight words or more, the same\n{'only here ' * i}", "en", "x", 9) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert "BroadcastHashJoin" not in plan_of(cp.dedup_lines(spark, docs, ""))
