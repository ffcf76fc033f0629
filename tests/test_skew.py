"""One file, key or kind of error that holds most of the rows."""

from pyspark.sql import functions as F

from siftgate.operators import audit, merge, validate
from siftgate.plans.load import staged
from siftgate.spec import FieldSpec, SourceSpec

FEED = SourceSpec("t", ("*",), (FieldSpec("key", "int"), FieldSpec("value", "float")), ("key",))


def skewed(spark, rows=30000):
    """Nine of ten records in one file; a third of them under one key; a third of them bad."""
    return spark.range(rows).selectExpr(
        "if(id % 10 = 0, concat('f', id % 7), 'hot') AS source_filename", "CAST(0 AS BIGINT) AS file_block", "id AS block_sequence",
        "CAST(NULL AS STRING) AS shape_error", "if(id % 3 = 1, '7', CAST(id AS STRING)) AS key",
        "if(id % 3 = 2, 'bad', CAST(id AS STRING)) AS value", "id + 2 AS file_row_number",
    )


def test_counts_samples_and_keys(spark):
    stage = staged(skewed(spark), FEED, carry=["file_row_number"])
    counts = {r.source_filename: r for r in validate.file_counts(stage).collect()}
    assert counts["hot"].records_processed == 27000
    assert sum(r.validation_errors for r in counts.values()) == 10000
    samples = validate.sample_errors(stage.filter("NOT is_valid")).filter("source_filename = 'hot'").orderBy("sample").collect()
    assert [r.file_row_number for r in samples] == sorted(n + 2 for n in range(60) if n % 10 and n % 3 == 2)[:6]
    groups = audit.key_groups(stage.filter("is_valid"), ["key"])
    hot = {r.source_filename: r for r in audit.grain_stats(groups, ["key"]).collect()}["hot"]
    assert (hot.grain_unique, hot.key_rows - hot.distinct_keys) == (0, counts["hot"].records_stage_loaded - hot.distinct_keys)
    top = audit.duplicate_examples(groups, ["key"]).filter("source_filename = 'hot'").collect()
    assert [r.key for r in top] == [7]


def test_last_row_of_a_hot_key(spark):
    rows = skewed(spark)
    latest = merge.latest_per_key(rows, ["key"], [F.desc("block_sequence")])
    expected = rows.groupBy("key").agg(F.max("block_sequence").alias("block_sequence"))
    assert latest.count() == expected.count() == latest.join(expected, ["key", "block_sequence"]).count()


def test_same_results_for_any_partitioning(spark):
    found = []
    for parts in (1, 5, 16):
        stage = staged(skewed(spark, 3000).repartition(parts), FEED)
        columns = ("block_sequence", "key", "is_valid", F.hex("etl_row_hash"))
        found.append(sorted(map(str, stage.select(*columns).collect())))
    assert found[0] == found[1] == found[2]
