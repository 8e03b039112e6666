"""Labels, codes, factors and name patterns of the billing format.

Every table below is a fixed value of the data format or of the published report
layout. Order matters wherever a table is read as "first match wins".
"""

# Line item types that take part in the reports.
FEE = "RIFee"
DISCOUNTED = "DiscountedUsage"
VM_DISCOUNTED = "VDiscountedUsage"
USAGE_TYPES = (DISCOUNTED, VM_DISCOUNTED)
REPORTED_TYPES = (FEE, DISCOUNTED, VM_DISCOUNTED)

# Size fragment of a usage type -> normalisation factor (first match wins).
SIZE_FACTORS = (
    (".nano", 0.25),
    (".micro", 0.5),
    (".small", 1.0),
    (".medium", 2.0),
    (".16xl", 128.0),
    (".18xl", 144.0),
    (".24xl", 192.0),
    (".32xl", 256.0),
    (".12xl", 96.0),
    (".10xl", 80.0),
    (".9xl", 72.0),
    (".8xl", 64.0),
    (".6xl", 48.0),
    (".4xl", 32.0),
    (".3xl", 24.0),
    (".2xl", 16.0),
    (".xl", 8.0),
    (".l", 4.0),
)

# Database usage types: one-zone and multi-zone markers.
SINGLE_ZONE_MARKERS = ("InstanceUsage", "HeavyUsage")
MULTI_ZONE_MARKERS = ("Multi-AZ", "MirrorUsage")
MULTI_ZONE_WEIGHT = 2.0

# Compute operation prefix -> operating system (first match wins).
COMPUTE_OPERATION = "RunInstances"
COMPUTE_PLAIN_LABEL = "Linux/UNIX"
COMPUTE_CODES = (
    ("0004", "Linux/UNIX and SQL Server Standard"),
    ("0100", "Linux/UNIX and SQL Server Enterprise"),
    ("0200", "Linux/UNIX and SQL Server Web"),
    ("0010", "Red Hat Enterprise Linux"),
    ("1010", "Red Hat Enterprise Linux with HA"),
    ("000g", "SUSE"),
    ("0002", "Windows"),
    ("0006", "Windows and SQL Server Standard"),
    ("0102", "Windows and SQL Server Enterprise"),
    ("0202", "Windows and SQL Server Web"),
    ("0800", "Windows (BYOL)"),
    ("0014", "Red Hat Enterprise Linux and SQL Server Standard"),
    ("0110", "Red Hat Enterprise Linux and SQL Server Enterprise"),
    ("0210", "Red Hat Enterprise Linux and SQL Server Web"),
    ("1014", "Red Hat Enterprise Linux with HA and SQL Server Standard"),
    ("1110", "Red Hat Enterprise Linux with HA and SQL Server Enterprise"),
)

# Database operation code -> engine.
DATABASE_OPERATION = "CreateDBInstance"
DATABASE_CODES = (
    ("0002", "MySQL"),
    ("0003", "Oracle SE1 (BYOL)"),
    ("0004", "Oracle SE (BYOL)"),
    ("0005", "Oracle EE (BYOL)"),
    ("0006", "Oracle SE1 (LI)"),
    ("0008", "SQL Server SE (BYOL)"),
    ("0009", "SQL Server EE (BYOL)"),
    ("0010", "SQL Server Exp (LI)"),
    ("0011", "SQL Server Web (LI)"),
    ("0012", "SQL Server SE (LI)"),
    ("0014", "PostgreSQL"),
    ("0015", "SQL Server EE (LI)"),
    ("0016", "Aurora MySQL"),
    ("0018", "MariaDB"),
    ("0019", "Oracle SE2 (BYOL)"),
    ("0020", "Oracle SE2 (LI)"),
    ("0021", "Aurora PostgreSQL"),
    ("0022", "Neptune"),
    ("0232", "SQL Server (on-premise for Outpost) Web"),
    ("0230", "SQL Server (on-premise for Outpost) EE"),
    ("0231", "SQL Server (on-premise for Outpost) SE"),
    ("0028", "Db2 SE (BYOL)"),
    ("0029", "Db2 AE (BYOL)"),
    ("0034", "Db2 SE (AWS Marketplace)"),
    ("0035", "Db2 AE (AWS Marketplace)"),
)

# Cache operation code -> engine (no label for other codes).
CACHE_OPERATION = "CreateCacheCluster"
CACHE_CODES = (
    ("0002", "Redis"),
    ("0001", "Memcached"),
    ("Valkey", "Valkey"),
)

# Engines and systems whose reservations are shared over a whole family.
BYOL_MARKER = "BYOL"
OPEN_ENGINES = ("MySQL", "Aurora MySQL", "PostgreSQL", "Aurora PostgreSQL", "MariaDB")

# Accelerator families: reservations never shared over sizes (any case).
ACCELERATOR_FAMILIES = (
    "g4ad", "g5", "g5g", "g6", "g6e", "gr6", "inf1", "g4dn", "inf2", "hpc7a", "p5",
    "u7i-6tb", "u7i-8tb",
)

# (region code prefix, usage type prefix, location), first match wins.
REGIONS = (
    ("us-east-2", "USE2", "Ohio"),
    ("us-east-1", "USE1", "N. Virginia"),
    ("us-west-1", "USW1", "N. California"),
    ("us-west-2", "USW2", "Oregon"),
    ("ap-east-1", "APE1", "Hong Kong"),
    ("ap-south-1", "APS3", "Mumbai"),
    ("ap-northeast-3", "APN3", "Osaka"),
    ("ap-northeast-2", "APN2", "Seoul"),
    ("ap-southeast-1", "APS1", "Singapore"),
    ("ap-southeast-2", "APS2", "Sydney"),
    ("ap-southeast-3", "APS4", "Jakarta"),
    ("ap-northeast-1", "APN1", "Tokyo"),
    ("ca-central-1", "CAN1", "Central"),
    ("eu-west-1", "EU", "Ireland"),
    ("eu-west-1", "EUW1", "Ireland"),
    ("eu-central-1", "EUC1", "Frankfurt"),
    ("eu-west-2", "EUW2", "London"),
    ("eu-west-3", "EUW3", "Paris"),
    ("eu-north-1", "EUN1", "Stockholm"),
    ("me-south-1", "MES1", "Bahrain"),
    ("sa-east-1", "SAE1", "Sao Paulo"),
    ("ug-west-1", "UGW1", "GovCloud (US)"),
    ("ug-east-1", "UGE1", "GovCloud (US-East)"),
    ("af-south-1", "AFS1", "Cape Town"),
    ("eu-south-1", "EUS1", "Milan"),
    ("me-central-1", "MEC1", "UAE"),
    ("ap-south-2", "APS2", "Hyderabad"),
)
