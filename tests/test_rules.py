import pytest

from idlewatch.functions import fixed_values as fixed
from idlewatch.functions import rules
from idlewatch.operators.services import engine_name, family_name, reservation_id, service_of


def evaluate(spark, expression, *rows, names):
    schema = ", ".join(f"{n} {t}" for n, t in names.items())
    result = spark.createDataFrame(list(rows), schema).selectExpr(f"{expression} AS x").collect()
    return [r.x for r in result]


def one_text(spark, rule, *values):
    return evaluate(spark, rule("v"), *[(v,) for v in values], names={"v": "string"})


@pytest.mark.parametrize(
    "usage_type, stored, expected",
    [
        ("USE1-HeavyUsage:m5.large", 9.0, 4.0),
        ("HeavyUsage:m5.xlarge", 9.0, 8.0),
        ("HeavyUsage:m5.16xlarge", 9.0, 128.0),
        ("HeavyUsage:m5.6xlarge", 9.0, 48.0),
        ("HeavyUsage:m5.48xlarge", 384.0, 384.0),
        ("HeavyUsage:m5.metal", None, None),
        ("HeavyUsage:t3.nano", None, 0.25),
        ("", 3.0, 3.0),
        (None, 3.0, 3.0),
    ],
)
def test_size_factor(spark, usage_type, stored, expected):
    names = {"u": "string", "f": "double"}
    assert evaluate(spark, rules.size_factor("u", "f"), (usage_type, stored), names=names) == [expected]


@pytest.mark.parametrize(
    "usage_type, expected",
    [
        ("InstanceUsage:db.m5.large", 4.0),
        ("USE1-HeavyUsage:db.t3.micro", 0.5),
        ("Multi-AZ:db.m5.large", 8.0),
        ("MirrorUsage:db.r5.2xlarge", 32.0),
        ("Multi-AZInstanceUsage:db.m5.large", 4.0),
        ("Other:db.m5.large", 1.5),
        ("InstanceUsage:db.m5.48xlarge", 1.5),
        (None, 1.5),
    ],
)
def test_size_factor_zoned(spark, usage_type, expected):
    rule = rules.size_factor_zoned("v", "1.5D")
    assert evaluate(spark, rule, (usage_type,), names={"v": "string"}) == [expected]


def test_labels(spark):
    assert one_text(
        spark, rules.os_label, "RunInstances", "RunInstances:0002", "RunInstances:0002:x",
        "RunInstances:00", "runinstances", None,
    ) == ["Linux/UNIX", "Windows", "Windows", "", "", ""]
    assert one_text(
        spark, rules.engine_label, "CreateDBInstance:0014", "CreateDBInstance:00140", None
    ) == ["PostgreSQL", "", ""]
    assert one_text(
        spark, rules.cache_engine_label, "CreateCacheCluster:Valkey", "CreateCacheCluster:0009", None
    ) == ["Valkey", None, None]


def test_region_order(spark):
    names = {"c": "string", "u": "string"}
    rows = [
        ("us-east-1", "x"), (None, "USE2-BoxUsage"), ("us-east-1", "USE2-BoxUsage"),
        ("ap-south-2", "x"), (None, "APS2-x"), ("eu-west-1", "x"), (None, "EU-x"), (None, None),
        ("us-east-1-wl1-bos", ""),
    ]
    assert evaluate(spark, rules.region_label("c", "u"), *rows, names=names) == [
        "N. Virginia", "Ohio", "Ohio", "Hyderabad", "Sydney", "Ireland", "Ireland", "",
        "N. Virginia",
    ]


def test_family(spark):
    names = {"t": "string", "e": "string"}
    rows = [
        ("m5.large", "Linux/UNIX"), ("m5.large", "Windows (BYOL)"), ("m5.large", "Windows"),
        ("G5.xlarge", "Linux/UNIX"), ("m5.large", None), ("", "Linux/UNIX"),
    ]
    rule = rules.family_label("t", "e", ("Linux/UNIX",), 1)
    assert evaluate(spark, rule, *rows, names=names) == [
        "m5", "m5", "m5.large", "G5.xlarge", "m5.large", "",
    ]


def test_services(spark):
    assert one_text(
        spark, service_of, "Amazon OpenSearch Service", "Amazon Elasticsearch Service",
        "Amazon Redshift", "Amazon Simple Storage Service", None,
    ) == ["opensearch", "opensearch", "redshift", None, None]
    arns = [
        ("ec2", "arn:aws:ec2:x:1:reserved-instances/abc"), ("rds", "arn:aws:rds:x:1:ri:abc"),
        ("redshift", "no-slash"),
    ]
    names = {"s": "string", "v": "string"}
    assert evaluate(spark, reservation_id("s", "v"), *arns, names=names) == ["abc", "abc", ""]
    assert evaluate(
        spark, engine_name("s", "v"), ("opensearch", "RunInstances"), ("elasticache", "x"), names=names
    ) == ["", None]
    assert evaluate(
        spark, family_name("s", "v", "'MySQL'"), ("rds", "db.m5.large"), ("redshift", "ra3.4xlarge"),
        names=names,
    ) == ["m5", "ra3.4xlarge"]


def test_fixed_values_fit_sql_literals():
    for table in (fixed.COMPUTE_CODES, fixed.DATABASE_CODES, fixed.CACHE_CODES, fixed.REGIONS):
        for row in table:
            assert not any("'" in value or "\\" in value for value in row)
