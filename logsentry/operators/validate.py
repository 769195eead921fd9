"""Row-by-row validation and scoring of mixed-type request records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentry.functions.rules import MODEL_VERSION, intrusion_score, is_intrusion, risk_level
from logsentry.sources.requests import batch_items, parse_body
from logsentry.sources.schemas import REQUEST_FIELDS

# Port range and error texts.
MIN_PORT = 0
MAX_PORT = 65535
MISSING_FIELDS = "Missing required fields"
INVALID_TYPES = "Invalid data types"
MISSING_FOR_PREDICTION = "Missing required fields for prediction."
INVALID_VALUES = "Invalid data types or values."
MISSING_DATA = "Missing 'data' field containing list of network connections."
DATA_NOT_LIST = "'data' field must be a list."
NOT_JSON = "Body is not valid JSON."


def field(record: Column, name: str) -> Column:
    """A field as VARIANT: SQL NULL when absent, a VARIANT null when it is JSON null."""
    return F.try_variant_get(record, f"$.{name}", "variant")


# JSON types by the leading word of a VARIANT's schema; other numbers are float.
_KINDS = {"BIGINT": "int", "STRING": "str", "BOOLEAN": "bool", "VOID": "NoneType", "OBJECT": "dict", "ARRAY": "list"}


def kind(value: Column) -> Column:
    """int, float, str, bool, NoneType, dict or list; meaningless when absent.

    80.0 is a float although it equals 80; integers beyond 64 bits are numbers but not
    ports. Written with one mention of ``value``: a filter on the result is pushed
    down by substitution, and repeated mentions would multiply.
    """
    names = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    word = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.coalesce(F.try_element_at(names, word), F.lit("float"))


def missing_fields(record: Column, required: list[str] | None = None) -> Column:
    """Names of absent fields. A field that is present but null is not missing."""
    names = [F.when(field(record, f).isNull(), F.lit(f)) for f in required or REQUEST_FIELDS]
    return F.array_compact(F.array(*names))


def check_fields(record: Column, required: list[str]) -> Column:
    """All required fields are present; an empty or missing record has none, extra fields are fine."""
    return F.coalesce(F.size(missing_fields(record, required)) == 0, F.lit(False))


# Fields whose types matter, in the order they are checked.
_PORTS = ["source_port", "destination_port"]
_TYPED = [*_PORTS, "payload_size", "protocol", "status", "user_agent"]


def _number(name: str) -> Column:
    """The value as DOUBLE; true and false count as 1 and 0. Text is ruled out by its kind."""
    return F.try_variant_get(F.col(f"_v_{name}"), "$", "double")


def _spread(records: DataFrame, record: str) -> DataFrame:
    """Add the record's fields (_v_), their kinds (_k_) and typed values (_x_), each read from the VARIANT once.

    They are separate columns added in steps: Catalyst keeps a step whose columns
    are used several times, where a struct would be taken apart and recomputed.
    """
    text = [n for n in _TYPED if n not in (*_PORTS, "payload_size")]
    return (
        records.withColumns({f"_v_{f}": field(F.col(record), f) for f in REQUEST_FIELDS})
        .withColumns({
            **{f"_k_{f}": kind(F.col(f"_v_{f}")) for f in _TYPED},
            **{f"_x_{f}": _number(f) for f in (*_PORTS, "payload_size")},
            **{f"_x_{f}": F.try_variant_get(f"_v_{f}", "$", "string") for f in text},
            "missing": F.array_compact(F.array(*[F.when(F.col(f"_v_{f}").isNull(), F.lit(f)) for f in REQUEST_FIELDS])),
        })
    )


def valid_types() -> Column:
    """Ports are integers in range, payload a number from 0, protocol and status texts. Other fields are not checked."""
    ok = F.col("_k_payload_size").isin("int", "float", "bool") & (F.col("_x_payload_size") >= 0)
    for p in _PORTS:
        ok = ok & F.col(f"_k_{p}").isin("int", "bool") & F.col(f"_x_{p}").between(MIN_PORT, MAX_PORT)
    for t in ("protocol", "status"):
        ok = ok & (F.col(f"_k_{t}") == "str")
    return F.coalesce(ok, F.lit(False))


def _assess(items: DataFrame, record: str, missing_text: str, invalid_text: str) -> DataFrame:
    """Add ``error`` and the nullable ``prediction`` struct for a VARIANT record; map-only.

    A bad record never stops the others: it gets an error text and no prediction.
    """
    agent = F.col("_k_user_agent")
    # A record that is no object has no fields, so its own kind is looked up only then.
    shape = kind(F.col(record))
    not_iterable = F.concat(F.lit("argument of type '"), shape, F.lit("' is not iterable"))
    error = (
        F.when(F.size("missing") > 0,
               F.when(shape.isin("int", "float", "bool", "NoneType"), not_iterable).otherwise(missing_text))
        .when(~valid_types(), invalid_text)
        .when(agent != "str", F.concat(F.lit("'"), agent, F.lit("' object has no attribute 'lower'")))
    )
    score = intrusion_score(
        F.col("_x_destination_port").cast("int"), F.col("_x_payload_size"), F.col("_x_protocol"), F.col("_x_status"),
        F.col("_x_user_agent"),
    )
    prediction = F.when(F.col("error").isNull(), F.struct(
        is_intrusion(F.col("_score")).alias("is_intrusion"), F.col("_score").alias("confidence"),
        risk_level(F.col("_score")).alias("risk_level"),
    ))
    return (
        _spread(items, record).withColumn("error", error)
        .withColumn("_score", F.when(F.col("error").isNull(), score))
        .select(*items.columns, "missing", "error", prediction.alias("prediction"))
    )


def reshape_record(record: Column) -> Column:
    """The nine request fields of a record as a struct of VARIANTs, whatever else it carries."""
    return F.struct(*[field(record, f).alias(f) for f in REQUEST_FIELDS])


def validate_records(bodies: DataFrame) -> DataFrame:
    """Per body (one record as JSON): missing field names and whether types and ranges hold."""
    parsed = parse_body(bodies)
    return _spread(parsed, "request").select(
        *bodies.columns, "missing", F.coalesce(F.size("missing") == 0, F.lit(False)).alias("has_fields"),
        valid_types().alias("valid_types"),
    ).drop("body")


def predict_one(bodies: DataFrame) -> DataFrame:
    """Score bodies that hold one record each: status code, error, prediction, the scored input, model_version."""
    out = _assess(parse_body(bodies), "request", MISSING_FOR_PREDICTION, INVALID_VALUES)
    error = F.when(F.col("request").isNull(), NOT_JSON).otherwise(F.col("error"))
    status = F.when(error.isNull(), 200).when(error.isin(MISSING_FOR_PREDICTION, INVALID_VALUES), 400).otherwise(500)
    return out.select(
        *bodies.columns, status.alias("status_code"), error.alias("error"), "prediction",
        F.when(error.isNull(), reshape_record(F.col("request"))).alias("input_data"),
        F.when(error.isNull(), MODEL_VERSION).alias("model_version"),
    ).drop("body")


def _body_items() -> Column:
    return F.expr("try_variant_get(request, '$.data', 'array<variant>')")


def _body_error() -> Column:
    """Why a parsed batch body is refused as a whole, or null."""
    data = field(F.col("request"), "data")
    return F.when(F.col("request").isNull(), NOT_JSON).when(data.isNull(), MISSING_DATA).when(_body_items().isNull(), DATA_NOT_LIST)


def body_errors(bodies: DataFrame) -> DataFrame:
    """Per batch body: its error, if the whole batch is refused, and total_processed."""
    return parse_body(bodies).withColumn("error", _body_error()).withColumn(
        "total_processed", F.when(F.col("error").isNull(), F.size(_body_items()))
    ).withColumn("model_version", F.lit(MODEL_VERSION)).drop("request", "body")


def assessed_bodies(bodies: DataFrame) -> DataFrame:
    """One row per item of every batch body, as ``score_batch``, and one row without an index per body that has no items.

    Each body is parsed once. ``error`` is that of the item, or of a body that is refused as a whole; ``total_processed`` is the body's.
    """
    parsed = parse_body(bodies).withColumn("_refused", _body_error()).withColumn("_items", _body_items())
    total = F.when(F.col("_refused").isNull(), F.size("_items"))
    rows = parsed.withColumn("total_processed", total).select(
        *[c for c in bodies.columns if c != "body"], "_refused", "total_processed", F.posexplode_outer("_items").alias("index", "item"))
    told = _assess(rows, "item", MISSING_FIELDS, INVALID_TYPES)
    return told.withColumn("error", F.when(F.col("index").isNull(), F.col("_refused")).otherwise(F.col("error"))).withColumn(
        "prediction", F.when(F.col("index").isNotNull(), F.col("prediction"))).drop("missing", "item", "_refused")


def score_batch(bodies: DataFrame) -> DataFrame:
    """One row per item of every batch body: index, error, prediction."""
    return _assess(batch_items(bodies), "item", MISSING_FIELDS, INVALID_TYPES).drop("missing", "item")
