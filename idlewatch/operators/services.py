"""The five reported services: one parameter set each, one pipeline for all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from idlewatch.functions import fixed_values as fixed
from idlewatch.functions import rules
from idlewatch.functions.sql import first_match, text, text_list


@dataclass(frozen=True)
class Service:
    key: str
    report_name: str                     # product_name in the fact table
    products: tuple[str, ...]            # product_name values in billing lines
    id_delimiter: str                    # reservation id inside the ARN
    id_part: int
    zoned_sizes: bool = False            # factor depends on the deployment zone
    engine: Callable[[str], str] | None = None
    open_names: tuple[str, ...] = ()     # engines sharing a family; empty: no family rule
    family_part: int = 0
    counts_instances: bool = False       # units are instances, not normalised units

    def short_id(self, arn: str) -> str:
        return f"split_part({arn}, {text(self.id_delimiter)}, {self.id_part})"


SERVICES = (
    Service(
        "ec2", "EC2(RIs)", ("Amazon Elastic Compute Cloud",), "/", 2,
        engine=rules.os_label, open_names=(fixed.COMPUTE_PLAIN_LABEL,), family_part=1,
    ),
    Service(
        "rds", "RDS", ("Amazon Relational Database Service",), ":", 7,
        zoned_sizes=True, engine=rules.engine_label, open_names=fixed.OPEN_ENGINES, family_part=2,
    ),
    Service(
        "elasticache", "ElastiCache", ("Amazon ElastiCache",), ":", 7,
        engine=rules.cache_engine_label,
    ),
    Service(
        "opensearch", "OpenSearch",
        ("Amazon Elasticsearch Service", "Amazon OpenSearch Service"), "/", 2,
        counts_instances=True,
    ),
    Service("redshift", "Redshift", ("Amazon Redshift",), "/", 2, counts_instances=True),
)

BY_KEY = {service.key: service for service in SERVICES}


def service_of(product_name: str) -> str:
    """Service key of a billing product name, NULL for products not reported."""
    return first_match(
        (f"{product_name} IN {text_list(s.products)}", text(s.key)) for s in SERVICES
    )


def per_service(service: str, value: Callable[[Service], str]) -> str:
    """A different expression per service, chosen by the service column."""
    return first_match((f"{service} = {text(s.key)}", value(s)) for s in SERVICES)


def is_service(service: str, test: Callable[[Service], bool]) -> str:
    return f"{service} IN {text_list(s.key for s in SERVICES if test(s))}"


def report_name(service: str) -> str:
    return per_service(service, lambda s: text(s.report_name))


def reservation_id(service: str, arn: str) -> str:
    return per_service(service, lambda s: s.short_id(arn))


def engine_name(service: str, operation: str) -> str:
    return per_service(service, lambda s: s.engine(operation) if s.engine else "''")


def family_name(service: str, instance_type: str, engine: str) -> str:
    def rule(s: Service) -> str:
        if not s.open_names:
            return instance_type
        return rules.family_label(instance_type, engine, s.open_names, s.family_part)

    return per_service(service, rule)
