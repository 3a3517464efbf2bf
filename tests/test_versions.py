import uuid

import pytest
from pyspark.sql import functions as F

from layerkit.operators import checks as C
from layerkit.operators.contracts import Contract, Field
from layerkit.sources.tables import create_layers
from layerkit.sources.versions import AuditFailed, keeps, passes, point_to, publish, write_version

KEYED = Contract("keyed", {"id": Field(("bigint",), nullable=False, unique=True)})


@pytest.fixture
def table(spark):
    create_layers(spark)
    return f"silver.t_{uuid.uuid4().hex}"


def test_readers_see_whole_versions_only(spark, tmp_path, table):
    root, audits = str(tmp_path), [keeps(KEYED), passes([C.missing("v", name="v", table="t")])]
    publish(spark.range(10).withColumn("v", F.lit(1)), root, table, audits)
    planned = spark.table(table)
    broken = spark.range(5).select(F.lit(1).cast("bigint").alias("id"), F.lit(None).cast("int").alias("v"))
    with pytest.raises(AuditFailed) as failed:
        publish(broken, root, table, audits)
    assert failed.value.findings == ["id unique: 5", "v: 5"]
    assert spark.table(table).count() == 10 and spark.read.parquet(failed.value.path).count() == 5
    # what was written without being published is not seen, and a planned read goes on with what it had
    unseen = write_version(spark.range(20).withColumn("v", F.lit(2)), root, table)
    assert spark.table(table).count() == 10
    point_to(spark, table, unseen)
    assert spark.table(table).agg(F.sum("v")).first()[0] == 40 and planned.count() == 10
    # the table's own rows can be read while its next version is written
    publish(spark.table(table).where("id < 3"), root, table, audits)
    assert spark.table(table).count() == 3


def test_first_version_that_fails_and_another_layout(spark, tmp_path, table):
    with pytest.raises(AuditFailed):
        publish(spark.range(3).withColumn("id", F.lit(1).cast("bigint")), str(tmp_path), table, [keeps(KEYED)])
    assert not spark.catalog.tableExists(table)
    publish(spark.range(3), str(tmp_path), table)
    with pytest.raises(AuditFailed, match="layout"):
        publish(spark.range(3).withColumn("more", F.lit(1)), str(tmp_path), table)
    assert spark.table(table).columns == ["id"]
