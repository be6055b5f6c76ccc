"""Declared schemas of the raw tables."""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


def indicators(*names: str) -> list[StructField]:
    return [StructField(n, DoubleType()) for n in names]


def both_levels(*stems: str) -> list[str]:
    return [f"{s}_{level}" for s in stems for level in ("ef", "em")]


KEYS = [
    StructField("ano", IntegerType()),
    StructField("id_municipio", StringType()),
    StructField("id_municipio_nome", StringType()),
]

FLOW_RAW = StructType(
    KEYS + indicators(*both_levels("taxa_promocao", "taxa_repetencia", "taxa_evasao"))
)

SCHOOL_RAW = StructType(
    KEYS
    + indicators(
        *both_levels(
            "atu", "had", "tdi", "taxa_aprovacao", "taxa_reprovacao", "taxa_abandono"
        )
    )
)
