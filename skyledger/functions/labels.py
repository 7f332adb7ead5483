"""Dictionary lookups with fallback."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pt-BR display labels.  Only four alert types carry a label; the
# others fall back to their code.
ALERT_TYPE_PT = {
    "cold_anomaly": "Anomalia de Frio",
    "precip_anomaly": "Anomalia de Precipitação",
    "heat_anomaly": "Anomalia de Calor",
    "heavy_rain": "Chuva Forte",
}
SEVERITY_PT = {
    "critical": "Crítica",
    "high": "Alta",
    "medium": "Média",
    "low": "Baixa",
}
CLASS_LABELS_PT = {
    "dry": "Seco",
    "light": "Leve",
    "moderate": "Moderado",
    "heavy": "Forte",
    "extreme": "Extremo",
}
_KINDS = {"alert_type": ALERT_TYPE_PT, "severity": SEVERITY_PT, "precipitation_class": CLASS_LABELS_PT}


def label(col, mapping: dict, fallback: bool = True) -> Column:
    """Literal-map lookup; unknown keys keep the raw value when ``fallback``."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    hit = F.try_element_at(m, c)
    return F.coalesce(hit, c) if fallback else hit


def label_pt(col, kind: str, fallback: bool = True) -> Column:
    """pt-BR label for an alert type, severity or rain class."""
    return label(col, _KINDS[kind], fallback)
