"""Record contracts of the event topics and service API.

Each record is a tuple of :class:`Field`; ``spark_schema`` turns it into a
``StructType`` for ``from_json`` and the validators in
:mod:`reelsight.operators.quality` check values against it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str                 # long | int | float | double | string | enum | array<long>
    nullable: bool = False
    symbols: tuple[str, ...] = ()


# The record contracts (field, type, nullable, enum symbols).
WATCH_EVENT = (
    Field("event", "enum", symbols=("watch",)),
    Field("user_id", "long"),
    Field("movie_id", "long"),
    Field("timestamp", "string"),
    Field("platform", "string", nullable=True),
)
RATE_EVENT = (
    Field("event", "enum", symbols=("rate",)),
    Field("user_id", "long"),
    Field("movie_id", "long"),
    Field("rating", "float"),
    Field("timestamp", "string"),
)
RECO_REQUEST_TOPIC = (
    Field("event", "enum", symbols=("reco_request",)),
    Field("user_id", "long"),
    Field("k", "int"),
    Field("timestamp", "string"),
)
RECO_RESPONSE_TOPIC = (
    Field("event", "enum", symbols=("reco_response",)),
    Field("user_id", "long"),
    Field("status", "string"),
    Field("latency_ms", "int"),
    Field("k", "int"),
    Field("movie_ids", "array<long>"),
    Field("timestamp", "string"),
)
RECO_REQUEST_API = (
    Field("user_id", "long"),
    Field("k", "int", nullable=True),
    Field("trace_id", "string", nullable=True),
)
RECO_RESPONSE_API = (
    Field("user_id", "long"),
    Field("items", "array<long>"),
    Field("model_version", "string", nullable=True),
    Field("generated_at", "long", nullable=True),
)
RECO_SERVED_EVENT = (
    Field("user_id", "long"),
    Field("items", "array<long>"),
    Field("request_k", "int"),
    Field("ts", "long"),
)

# Default topic -> schema subject pointers (a deployment passes its own);
# topics without a pointer use ``{topic}-value``.
SUBJECTS = {
    "reco.watch": "reco.watch-value",
    "reco.rate": "reco.rate-value",
    "reco.reco_requests": "reco.reco_requests-value",
    "reco.reco_responses": "reco.reco_responses-value",
}
RECORDS_BY_SUBJECT = {
    "reco.watch-value": WATCH_EVENT,
    "reco.rate-value": RATE_EVENT,
    "reco.reco_requests-value": RECO_REQUEST_TOPIC,
    "reco.reco_responses-value": RECO_RESPONSE_TOPIC,
}

_SPARK = {
    "long": T.LongType(), "int": T.IntegerType(), "float": T.FloatType(), "double": T.DoubleType(),
    "string": T.StringType(), "enum": T.StringType(), "array<long>": T.ArrayType(T.LongType()),
}


def spark_schema(record: tuple[Field, ...]) -> T.StructType:
    return T.StructType([T.StructField(f.name, _SPARK[f.type], True) for f in record])


INTERACTIONS = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.LongType()),
])
