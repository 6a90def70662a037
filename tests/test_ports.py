import pytest
from pyspark.sql import functions as F

from meshlark.functions.ports import SERVICE_NAMES, classify_service_port, parsed_port, port_service_name, with_service_name

CASES = [(52000, 443, 443), (80, 52000, 80), (22, 80, 22), (3306, 52000, 3306), (52000, 3306, 3306),
         (40000, 41000, 40000), (41000, 40000, 40000), (None, 80, None), (80, None, None), (None, None, None),
         (1, 22, 22), (9, 7, 7)]


def test_classify(spark):
    rows = spark.createDataFrame(CASES, "s int, d int, want int")
    got = rows.select("s", "d", "want", classify_service_port(F.col("s"), F.col("d")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_constant_side(spark):
    rows = spark.createDataFrame([(443,), (50001,)], "s int")
    got = [r[0] for r in rows.select(classify_service_port(F.col("s"), 50000)).collect()]
    assert got == [443, 50000]


@pytest.mark.parametrize("port,name", [(443, "HTTPS"), (80, "HTTP"), (22, "SSH"), (3306, "MySQL"), (53, "DNS"), (99999, None)])
def test_names(spark, port, name):
    one = spark.range(1).select(F.lit(port).alias("service_port"))
    assert one.select(port_service_name(F.col("service_port"))).first()[0] == name
    assert with_service_name(one).first().service_name == name


def test_table_and_unknown(spark):
    assert len(SERVICE_NAMES) == 110
    assert spark.range(1).select(port_service_name(F.lit(None).cast("int"))).first()[0] is None


def test_parse(spark):
    rows = spark.createDataFrame([("443",), ("443.7",), ("x",), (None,), ("",)], "p string")
    assert [r[0] for r in rows.select(parsed_port(F.col("p"))).collect()] == [443, 443, None, None, None]
