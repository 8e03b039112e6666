"""Constants shared by the derived billing relation and its SQL twin.

The given tables hold no billing lines, so both sides derive them from ``events``,
``customer`` and ``nation`` by the same integer arithmetic. Amounts are multiples of
1/1024: sums are exact in any order, in both engines.
"""

YEAR, MONTH = 2024, 1
PAYER_BASE, ACCOUNT_BASE = 100_000_000_000, 200_000_000_000
# The payers asked for: all but one that has lines. Another one has no name.
PAYER_IDS = [str(PAYER_BASE + n) for n in range(24)]
UNNAMED_NATION = 5
# Days by which the start of fees (of user k) and usage lines (of event_id) move out of the month.
FEE_SHIFT = "CASE WHEN k % 19 = 0 OR (variant = 1 AND k % 3 <> 0) THEN -31 ELSE 0 END"
USAGE_SHIFT = "CASE event_id % 13 WHEN 0 THEN -31 WHEN 1 THEN 31 ELSE 0 END"
UNREGISTERED_SEGMENT = "FURNITURE"

# Indexed by k % 5: compute, database, cache, search, warehouse.
ARN_SERVICE = ["ec2", "rds", "elasticache", "es", "redshift"]
ARN_TAIL = [
    ":reserved-instances/ri-", ":ri:ri-", ":reserved-instance:ri-", ":reserved-instances/ri-",
    ":reserved-node/ri-",
]
USAGE_TYPES = [
    [
        "USE1-HeavyUsage:m5.large", "EUC1-HeavyUsage:c5.xlarge", "HeavyUsage:r5.16xlarge",
        "APS2-HeavyUsage:m5.48xlarge", "USW2-HeavyUsage:m5.metal", "HeavyUsage:G5.2xlarge",
        "APS3-HeavyUsage:t3.nano", "EU-HeavyUsage:t3.medium",
    ],
    [
        "USE1-InstanceUsage:db.m5.large", "EUC1-Multi-AZ:db.r5.xlarge", "HeavyUsage:db.r5.16xlarge",
        "MirrorUsage:db.t3.micro", "USE2-InstanceUsage:db.m5.48xlarge", "Other:db.m5.large",
        "Multi-AZ:db.g5.2xlarge", "CAN1-InstanceUsage:db.t3.small",
    ],
    [
        "USE1-HeavyUsage:cache.m5.large", "NodeUsage:cache.r5.12xlarge", "APN1-NodeUsage:cache.t3.micro",
        "NodeUsage:cache.m6.9xlarge", "EUW1-NodeUsage:cache.r6gd.metal", "NodeUsage:cache.t2.small",
        "SAE1-NodeUsage:cache.m4.10xlarge", "NodeUsage:cache.r4.3xlarge",
    ],
    [
        "USE1-HeavyUsage:m5.large.search", "ESInstance:r5.xlarge.search", "EUW2-ESInstance:c5.18xlarge.search",
        "ESInstance:i3.8xlarge.search", "AFS1-ESInstance:t3.small.search", "ESInstance:m6.32xlarge.search",
        "APS1-ESInstance:r6.6xlarge.search", "ESInstance:m5.24xlarge.search",
    ],
    [
        "USW2-Node:ra3.4xlarge", "Node:dc2.large", "EUN1-Node:ra3.xlplus", "Node:ra3.16xlarge",
        "MES1-Node:dc2.8xlarge", "Node:ds2.xlarge", "Node", "MEC1-Node:ds2.8xlarge",
    ],
]
OPERATIONS = [
    [
        "RunInstances", "RunInstances:0002", "RunInstances:0800", "RunInstances:9999",
        "RunInstances:000g", "RunInstances:1014", None,
    ],
    [
        "CreateDBInstance:0002", "CreateDBInstance:0003", "CreateDBInstance:0014",
        "CreateDBInstance:9999", "CreateDBInstance:0022", "CreateDBInstance:0021", None,
    ],
    [
        "CreateCacheCluster:0002", "CreateCacheCluster:0001", "CreateCacheCluster:Valkey",
        "CreateCacheCluster:9999", "CreateCacheCluster:0002", "CreateCacheCluster:0001", None,
    ],
    ["ESDomain"] * 7,
    ["RunComputeNode:0001"] * 7,
]
# Indexed by k % 2: search lines carry the older or the newer name.
PRODUCTS = [
    ["Amazon Elastic Compute Cloud"] * 2,
    ["Amazon Relational Database Service"] * 2,
    ["Amazon ElastiCache"] * 2,
    ["Amazon Elasticsearch Service", "Amazon OpenSearch Service"],
    ["Amazon Redshift"] * 2,
]
REGION_CODES = ["us-east-1", "eu-central-1", "ap-south-2", None, "xx-none-1", "sa-east-1"]
