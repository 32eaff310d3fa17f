import os

import pytest
from pyspark.sql import functions as F

from newsflow.operators import enrich, summary_store
from newsflow.operators.summary_store import attach_table, create_store, open_store

from newsflow.session import materialize

from .messages import message
from .test_enrich import Recorder, by_id, cleaned


def made(spark, numbers, summary="s"):
    ids = spark.createDataFrame([(n,) for n in numbers], "news_id long")
    return ids.select("news_id", F.sha2(F.col("news_id").cast("string"), 256).alias("prompt_hash"), F.concat(F.lit(summary), "news_id").alias("summary"))


def asked(spark, numbers):
    return made(spark, numbers).select(F.col("news_id").alias("id"), "prompt_hash", F.lit("text").alias("_text"))


def answers(store, articles):
    return sorted((r.id, r._known) for r in store.attach(articles).collect())


@pytest.mark.parametrize("blocks", [16, summary_store.BROADCAST_BLOCKS + 1])
def test_known_articles_only(spark, tmp_path, blocks):
    store = create_store(spark, f"{tmp_path}/store", buckets=4, blocks=blocks)
    assert answers(store, asked(spark, [1, 2])) == [(1, None), (2, None)]
    store.add(made(spark, range(0, 40)))
    store.add(made(spark, range(40, 60)))
    wanted = [(n, f"s{n}" if n < 60 else None) for n in range(200)]
    assert answers(store, asked(spark, range(200))) == wanted
    assert answers(open_store(spark, f"{tmp_path}/store"), asked(spark, range(200))) == wanted


def test_cases(spark, tmp_path):
    store = create_store(spark, f"{tmp_path}/store", buckets=4)
    twice = made(spark, [1, 1, 2])
    store.add(twice.unionByName(made(spark, [3]).withColumn("summary", F.lit(None).cast("string"))))
    store.add(made(spark, [2], "r"))
    # Repeated articles, one without a prompt, one with another prompt than the stored one.
    odd = asked(spark, [1, 2, 2, 3])
    none = asked(spark, [1]).withColumn("prompt_hash", F.lit(None).cast("string"))
    other = asked(spark, [1]).withColumn("prompt_hash", F.lit("other"))
    found = [r._known for r in store.attach(odd.unionByName(none).unionByName(other)).orderBy("id", F.col("prompt_hash").desc_nulls_last(), "_known").collect()]
    assert sorted(found, key=str) == sorted(["s1", "r2", "r2", None, None, None], key=str)


def test_repeated_addition_and_compaction(spark, tmp_path):
    root = f"{tmp_path}/store"
    store = create_store(spark, root, buckets=4, blocks=16)
    for _ in range(2):
        store.add(made(spark, range(30)))
    assert spark.table(store.table).count() == 60 and store.rows().count() == 30
    new = store.compact(buckets=2, blocks=64)
    assert spark.table(new.table).count() == 30
    files = [f for f in os.listdir(f"{root}/summaries-000001") if f.startswith("part-")]
    assert len(files) == 2
    again = open_store(spark, root)
    assert (again.generation, again.buckets, again.blocks) == (1, 2, 64)
    wanted = [(n, f"s{n}" if n < 30 else None) for n in range(60)]
    assert answers(again, asked(spark, range(60))) == wanted
    again.remove_older()
    assert not os.path.exists(f"{root}/summaries-000000") and answers(again, asked(spark, range(60))) == wanted


def test_compaction_that_stopped_changes_nothing(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/store"
    store = create_store(spark, root, buckets=2)
    store.add(made(spark, range(10)))

    def stop(self):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(summary_store.SummaryStore, "_commit", stop)
        with pytest.raises(RuntimeError):
            store.compact()
    assert open_store(spark, root).generation == 0
    new = open_store(spark, root).compact()
    assert new.generation == 1 and spark.table(new.table).count() == 10


def test_filter_has_no_misses_and_few_false_hits(spark, tmp_path):
    store = create_store(spark, f"{tmp_path}/store", buckets=4, blocks=400)
    store.add(spark.range(10_000).select(F.col("id").alias("news_id"), F.sha2(F.col("id").cast("string"), 256).alias("prompt_hash"), F.lit("s").alias("summary")))
    assert store.known().count() <= 400
    key = (F.col("id"), F.sha2(F.col("id").cast("string"), 256))
    held = store.known().select("block", *[F.col(w).alias(f"held_{w}") for w in summary_store.WORDS])
    words = [c.alias(w) for c, w in zip(summary_store._words(*key), summary_store.WORDS, strict=True)]
    probes = spark.range(20_000).select("id", store._block(*key).alias("block"), *words).join(held, "block")
    hits = probes.where(" AND ".join(f"(held_{w} & {w}) = {w}" for w in summary_store.WORDS))
    assert hits.where("id < 10000").count() == 10_000
    assert hits.where("id >= 10000").count() < 300


def test_store_is_not_moved(spark, tmp_path):
    store = create_store(spark, f"{tmp_path}/store", buckets=8)
    store.add(made(spark, range(50)))
    keys = made(spark, range(100)).select("news_id", "prompt_hash").distinct()
    plan = keys.hint("merge").join(store.rows(), ["news_id", "prompt_hash"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    # The store's side is the last one below the join: from its scan up to the join nothing is moved.
    depth, above = lines[scan].index("FileScan"), []
    for line in reversed(lines[join + 1 : scan]):
        indent = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if indent < depth:
            above, depth = [*above, line], indent
    assert "Bucketed: true" in lines[scan] and above and not any("Exchange" in line for line in above)


def test_summaries_come_from_the_store(spark, tmp_path):
    service = Recorder(tmp_path / "calls")
    os.mkdir(service.folder)
    articles = cleaned(spark, message({"id": 1}), message({"id": 2}, body="other"), message({"id": 3}, body=""))
    store = create_store(spark, f"{tmp_path}/store", buckets=2)
    rows = spark.createDataFrame(enrich.summarize_articles(articles.where("id = 1"), service).select("id", "prompt_hash", "summary", "attempts").collect())
    store.add(enrich.summary_store(rows))
    done = by_id(enrich.summarize_articles(articles, service, stored=store))
    assert service.calls() == 2 and [r.attempts for r in done] == [0, 1, 0]
    assert done[0].summary.startswith("summary of") and done[2].summary == "More flour from the coast"


@pytest.mark.parametrize("blocks", [1, 4096])
def test_a_table_is_matched_without_moving_texts(spark, blocks):
    articles = asked(spark, [*range(200), 7, 150])
    odd = articles.limit(1).select(F.lit(None).cast("long").alias("id"), "prompt_hash", "_text")
    none = asked(spark, [1]).withColumn("prompt_hash", F.lit(None).cast("string"))
    other = asked(spark, [1]).withColumn("prompt_hash", F.lit("other"))
    articles = materialize(articles.unionByName(odd).unionByName(none).unionByName(other), "articles")
    table = made(spark, range(60)).hint("merge")
    found = attach_table(articles, table, blocks)
    rows = sorted((str(r.id), r._known or "", r._text or "") for r in found.collect())
    wanted = [(str(n), f"s{n}" if n < 60 else "", "" if n < 60 else "text") for n in [*range(200), 7, 150]]
    assert rows == sorted([*wanted, ("None", "", "text"), ("1", "", "text"), ("1", "", "text")])


def test_texts_stay_where_the_filter_decides(spark, tmp_path):
    """Bytes that the match of 400 texts of 10 KB shuffles, half of them known."""
    texts = materialize(asked(spark, range(400)).select("id", "prompt_hash", F.lit("").alias("_teaser"), F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(160)), lambda k: F.sha2(F.concat(F.col("id"), k), 256))).alias("body")), "texts")
    table = made(spark, range(200)).select("news_id", F.lit("other").alias("prompt_hash"), "summary").hint("merge")
    done = enrich.summarize_articles(texts.withColumn("teaser_clean", F.lit("")), enrich.LeadingSentences(), text=F.col("body"), stored=table, columns=("id",), read_again=True)
    plan = done._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [plan[k + 1] for k, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert done.count() == 400 and not any("_text" in line or "body" in line for line in below)
