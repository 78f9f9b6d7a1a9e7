"""What grows with the corpus is not broadcast, however small Spark takes it to be."""

import corpus_pipeline
from pyspark.sql import functions as F

from tidemerge.llm import mixing, simhash
from tidemerge.llm.components import _large_star, _small_star
from tidemerge.llm.base import stored, table


def grown(df):
    """Parts of the plan that are broadcast and come from files or from Python, whose rows Spark does not know."""
    lines, found = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            found += [x for x in lines[i:end] if "FileScan" in x or "MapInArrow" in x]
    return found


def test_slots_and_pieces_of_a_mix_are_not_broadcast(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text", "source")
    assert not grown(mixing.mix_counts(docs)) and not grown(mixing.mix(docs))
    few = spark.range(3).select("id", F.lit(1).alias("one"))
    assert not grown(few.join(F.broadcast(few), "id"))
    read = docs.groupBy("doc_id").count()
    assert grown(read.join(F.broadcast(read), "doc_id"))


def test_fingerprints_and_links_are_not_broadcast(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    prints = stored(docs.select("doc_id", F.xxhash64("text").alias("fp")), "test-prints")
    assert not grown(simhash.links(prints.select("fp").distinct()))
    assert not grown(simhash.near_duplicates(docs))
    links = stored(prints.select(F.col("fp").alias("a"), F.col("doc_id").alias("b")), "test-links")
    assert not grown(_large_star(links)) and not grown(_small_star(links))


def test_the_mix_of_the_pipeline_broadcasts_no_slots(spark, folder):
    assert not grown(dict(corpus_pipeline.STAGES)["mix"](spark, table(spark, folder, "documents"), folder))
