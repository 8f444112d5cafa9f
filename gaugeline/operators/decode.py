"""Untrusted text to records: parse, check, split into valid rows and rejected ones. One bad record never fails a job.

A record is parsed once, its fields as variants: these say whether text, a number or an object was sent, and give its text, from
which numbers sent as text are understood as well. All of it runs in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import schemas
from gaugeline.functions import validity as ok
from gaugeline.session import prepare

Split = tuple[DataFrame, DataFrame]
Check = tuple[str, Column]


def _evaluated_once(df: DataFrame, *done: str, **columns: Column) -> DataFrame:
    """Add columns that are used many times, and drop those that are `done` with. Next to the partition's number, which is
    no pure function of the row, they are not copied into each of their uses; for parsed JSON that would mean a parse per
    field and check."""
    parts = [column.alias(name) for name, column in columns.items()]
    return df.withColumn("_once", F.struct(*parts, F.spark_partition_id().alias("_part"))).select(
        *[c for c in df.columns if c not in done], *[F.col(f"_once.{name}").alias(name) for name in columns]
    )


def _parsed(text: str, **kinds: str) -> Column:
    """The named fields of a JSON object. What is no object, or no JSON, has none."""
    return F.from_json(text, ", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))


def _is_object(text: Column) -> Column:
    return F.coalesce(F.startswith(F.ltrim(text), F.lit("{")), F.lit(False))


def _text_of(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "string")


def _is_text(value: Column) -> Column:
    return ok.sure(F.schema_of_variant(value) == "STRING")


def _number_of(value: Column, path: str = "$") -> Column:
    """A number sent as a number or as text; null for anything else."""
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant") if path != "$" else value)
    plain = F.when(kind != "BOOLEAN", F.try_variant_get(value, path, "double"))
    return F.when(kind == "STRING", ok.number(_text_of(value, path))).otherwise(plain)


def _named_values(value: Column) -> Column:
    """The values of an object by name; null if it is none."""
    return F.try_variant_get(value, "$", "map<string, variant>")


def _texts_by_name(values: Column) -> Column:
    return F.transform_values(values, lambda _, v: _text_of(v))


def _texts_by_name_ok(value: Column, values: Column) -> Column:
    """Absent, or an object whose values are all text."""
    return _text_of(value).isNull() | ok.sure(F.forall(F.map_values(values), _is_text))


def _first_failure(checks: list[Check]) -> Column:
    """The name of the first check that fails, null when all hold."""
    return F.coalesce(*[F.when(~condition, F.lit(reason)) for reason, condition in checks])


def _texts(names: list[str], raw: Column, sent: Column) -> list[Check]:
    return [(f"{name}: non-empty text expected", sent[name] & ok.non_empty(raw[name])) for name in names]


def _present(names: list[str], fields: Column, expected: str) -> list[Check]:
    """Fields whose conversion gave a value."""
    return [(f"{name}: {expected} expected", fields[name].isNotNull()) for name in names]


_METRIC_TEXTS = ["name", "type", "unit", "machine_id"]
_EVALUATION_TEXTS = ["machine_id", "metric_name", "algorithm"]
_MACHINE_TEXTS = ["machine_id", "hostname", "os", "os_version", "architecture"]


def _metric_fields(raw: Column) -> list[Column]:
    return [
        raw["timestamp"].alias("timestamp"),
        raw["name"].alias("name"),
        raw["type"].alias("type"),
        raw["unit"].alias("unit"),
        raw["value"].alias("value"),
        raw["machine_id"].alias("machine_id"),
        ok.normalise_uuid(raw["metric_id"]).alias("metric_id"),
        raw["attributes"].alias("attributes"),
    ]


def _metric_checks(raw: Column, sent: Column, fields: Column) -> list[Check]:
    return [
        *_texts(_METRIC_TEXTS, raw, sent),
        *_present(["timestamp", "value"], fields, "number"),
        *_present(["metric_id"], fields, "UUID"),
        ("attributes: texts by name expected", sent["attributes"]),
    ]


def _evaluation_fields(raw: Column) -> list[Column]:
    return [
        ok.normalise_uuid(raw["metric_id"]).alias("metric_id"),
        raw["machine_id"].alias("machine_id"),
        raw["metric_name"].alias("metric_name"),
        raw["timestamp"].alias("timestamp"),
        raw["algorithm"].alias("algorithm"),
        raw["baseline"].alias("baseline"),
        raw["lower"].alias("lower"),
        raw["upper"].alias("upper"),
        ok.boolean(raw["is_anomaly"]).alias("is_anomaly"),
    ]


def _evaluation_checks(raw: Column, sent: Column, fields: Column) -> list[Check]:
    return [
        *_texts(_EVALUATION_TEXTS, raw, sent),
        *_present(["timestamp", "baseline", "upper"], fields, "number"),
        ("lower: number or null expected", sent["lower"] | fields["lower"].isNotNull()),
        *_present(["is_anomaly"], fields, "true or false"),
        *_present(["metric_id"], fields, "UUID"),
    ]


def _machine_fields(raw: Column) -> list[Column]:
    return [
        *[raw[name].alias(name) for name in _MACHINE_TEXTS],
        ok.whole_number(raw["cores"], "int").alias("cores"),
        ok.whole_number(raw["total_memory"]).alias("total_memory"),
        ok.whole_number(raw["total_disk"]).alias("total_disk"),
        F.when(ok.aware_timestamp(raw["last_boot"]).isNotNull(), raw["last_boot"]).alias("last_boot"),
        raw["last_seen_at"].alias("last_seen_at"),
    ]


def _machine_checks(raw: Column, sent: Column, fields: Column) -> list[Check]:
    return [
        *_texts(_MACHINE_TEXTS, raw, sent),
        *[
            (f"{name}: whole number from 0 expected", ok.sure(fields[name] >= 0))
            for name in ("cores", "total_memory", "total_disk")
        ],
        *_present(["last_boot"], fields, "time with offset"),
        *_present(["last_seen_at"], fields, "number"),
    ]


_NUMBERS = {"timestamp", "value", "baseline", "lower", "upper", "last_seen_at"}

#: Per stream its record, the fields that only text will do for, the conversion and the checks.
_ENTITIES = {
    "metrics": (schemas.SAMPLE_STREAM, _METRIC_TEXTS, _metric_fields, _metric_checks),
    "evaluations": (schemas.EVALUATION_STREAM, _EVALUATION_TEXTS, _evaluation_fields, _evaluation_checks),
    "machines": (schemas.MACHINE_STREAM, _MACHINE_TEXTS, _machine_fields, _machine_checks),
}


def examine(values: DataFrame, entity: str) -> DataFrame:
    """`values` with `record`, its converted fields, and `reason`, why it is malformed (null if it is not)."""
    schema, texts_of, fields_of, checks_of = _ENTITIES[entity]
    prepare(values.sparkSession)
    names = schema.fieldNames()
    parsed, raw, fields = F.col("_parsed"), F.col("_raw"), F.col("record")
    rows = _evaluated_once(values, _parsed=_parsed("value", **dict.fromkeys(names, "variant")))
    read = {name: _number_of if name in _NUMBERS else _text_of for name in names if name != "attributes"}
    texts = [how(parsed[name]).alias(name) for name, how in read.items()]
    sent = [_is_text(parsed[name]).alias(name) for name in texts_of]
    if "lower" in names:
        sent.append(_text_of(parsed["lower"]).isNull().alias("lower"))
    if "attributes" in names:
        values_by_name = _named_values(parsed["attributes"])
        texts.append(_texts_by_name(values_by_name).alias("attributes"))
        sent.append(_texts_by_name_ok(parsed["attributes"], values_by_name).alias("attributes"))
    shaped = _is_object(F.col("value")) & parsed.isNotNull()
    rows = _evaluated_once(rows, "_parsed", _raw=F.struct(*texts), _sent=F.struct(*sent, shaped.alias("shaped")))
    rows = _evaluated_once(rows, record=F.struct(*fields_of(raw)))
    failure = _first_failure(checks_of(raw, F.col("_sent"), fields))
    reason = F.when(~F.col("_sent.shaped"), F.lit("JSON object expected")).otherwise(failure)
    return rows.withColumn("reason", reason).drop("_raw", "_sent")


def valid_records(examined: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return examined.where(F.col("reason").isNull()).select("record.*", *keep)


def malformed_records(examined: DataFrame) -> DataFrame:
    """What was skipped, why, and where in its stream it stood, as far as known."""
    position = [c for c in ("topic", "partition", "offset") if c in examined.columns]
    return examined.where(F.col("reason").isNotNull()).select(*position, "value", "reason")


def decode(values: DataFrame, entity: str, keep: tuple[str, ...] = ()) -> Split:
    """A DataFrame with a `value` column to (valid records, malformed ones). `keep` names columns to carry along."""
    examined = examine(values, entity)
    return valid_records(examined, keep), malformed_records(examined)


_OBSERVATION_TEXTS = ["name", "type", "unit"]


def _observations(metrics: Column) -> Column:
    """The fields of each observation, and whether they are as they should be; each step works out every part once."""
    parts = F.transform(
        metrics,
        lambda m: F.struct(
            *[F.try_variant_get(m, f"$.{name}", "variant").alias(name) for name in (*_OBSERVATION_TEXTS, "attributes")],
            _number_of(m, "$.value").alias("value"),
        ),
    )
    texts = F.transform(
        parts,
        lambda p: F.struct(
            *[F.when(_is_text(p[name]), _text_of(p[name])).alias(name) for name in _OBSERVATION_TEXTS],
            p["value"].alias("value"),
            p["attributes"].alias("attributes"),
            _named_values(p["attributes"]).alias("values"),
        ),
    )
    return F.transform(
        texts,
        lambda t: F.struct(
            *[t[name].alias(name) for name in (*_OBSERVATION_TEXTS, "value")],
            _texts_by_name(t["values"]).alias("attributes"),
            reduce(
                lambda a, b: a & b,
                [ok.non_empty(t[name]) for name in _OBSERVATION_TEXTS],
                t["value"].isNotNull() & _texts_by_name_ok(t["attributes"], t["values"]),
            ).alias("ok"),
        ),
    )


def examine_snapshots(bodies: DataFrame) -> DataFrame:
    """Snapshot bodies `(url, body)` with the parsed parts and `error`: one bad observation rejects the whole body."""
    prepare(bodies.sparkSession)
    rows = _evaluated_once(bodies, _parsed=_parsed("body", machine_id="variant", timestamp="variant", metrics="array<variant>"))
    parsed = F.col("_parsed")
    rows = _evaluated_once(
        rows,
        "_parsed",
        _machine_id=F.when(_is_text(parsed["machine_id"]), _text_of(parsed["machine_id"])),
        _epoch=ok.iso_to_epoch(_text_of(parsed["timestamp"])),
        _metrics=_observations(parsed["metrics"]),
        _shaped=_is_object(F.col("body")) & parsed.isNotNull(),
    )
    checks = [
        ("machine_id: non-empty text expected", ok.non_empty(F.col("_machine_id"))),
        ("timestamp: time with offset expected", F.col("_epoch").isNotNull()),
        ("metrics: list expected", F.col("_metrics").isNotNull()),
        ("metrics: malformed observation", ok.sure(F.forall("_metrics", lambda m: m["ok"]))),
    ]
    error = F.when(~F.col("_shaped"), F.lit("JSON object expected")).otherwise(_first_failure(checks))
    return rows.withColumn("error", error).drop("_shaped")


def snapshot_samples(examined: DataFrame) -> DataFrame:
    """One sample per observation of the valid bodies, with the body's machine and time and an id of its own."""
    flat = examined.where(F.col("error").isNull()).select(
        F.col("_machine_id").alias("machine_id"),
        F.col("_epoch").alias("timestamp"),
        F.posexplode("_metrics").alias("position", "m"),
    )
    samples = flat.select(
        "timestamp",
        F.col("m.name").alias("name"),
        F.col("m.type").alias("type"),
        F.col("m.unit").alias("unit"),
        F.col("m.value").alias("value"),
        "machine_id",
        F.col("m.attributes").alias("attributes"),
        "position",
    )
    return with_metric_id(samples).select(*schemas.SAMPLE_STREAM.fieldNames())


def rejected_bodies(examined: DataFrame) -> DataFrame:
    return examined.where(F.col("error").isNotNull()).drop("_machine_id", "_metrics", "_epoch")


def explode_snapshots(bodies: DataFrame) -> Split:
    """Bodies to (samples, rejected bodies with their error)."""
    examined = examine_snapshots(bodies)
    return snapshot_samples(examined), rejected_bodies(examined)


def examine_machines(bodies: DataFrame) -> DataFrame:
    return examine(bodies.withColumn("value", F.col("body")), "machines")


def rejected_machines(examined: DataFrame) -> DataFrame:
    rejected = examined.where(F.col("reason").isNotNull()).withColumnRenamed("reason", "error")
    return rejected.drop("record", "value")


def machine_records(bodies: DataFrame) -> Split:
    """Machine bodies `(url, body)` to (records, rejected bodies with their error)."""
    examined = examine_machines(bodies)
    return valid_records(examined), rejected_machines(examined)


def is_machine(bodies: DataFrame) -> Column:
    """Whether a body answers a request for the machine record; without a `kind` all are metrics."""
    return F.col("kind").eqNullSafe("machine") if "kind" in bodies.columns else F.lit(False)


def examine_bodies(bodies: DataFrame) -> DataFrame:
    """Bodies of both kinds, told apart by `asked`, with `error` and, where there is none, what they hold: the parsed parts of a
    snapshot or a machine's `record`. Only a rejected body keeps its text: no more is stored than what goes on from here."""
    flawed = F.col("error").isNotNull()

    def outcome(examined: DataFrame, asked: str, *held: str) -> DataFrame:
        parts = [F.when(~flawed, F.col(name)).alias(name) for name in held]
        return examined.select("url", F.lit(asked).alias("asked"), "error", F.when(flawed, F.col("body")).alias("body"), *parts)

    machine = is_machine(bodies)
    metrics = outcome(examine_snapshots(bodies.where(~machine)), "metrics", "_machine_id", "_epoch", "_metrics")
    if "kind" not in bodies.columns:
        return metrics
    machines = examine_machines(bodies.where(machine)).withColumnRenamed("reason", "error")
    return outcome(machines, "machine", "record").unionByName(metrics, allowMissingColumns=True)


def with_metric_id(samples: DataFrame) -> DataFrame:
    """Add `metric_id`: a time-ordered UUID (version 7 layout) made from the sample itself.

    A sample that is read again gets the same id, so a retried task or a body collected twice adds no second sample.
    `position`, if present, tells equal observations of one snapshot apart.
    """
    millis = (F.col("timestamp") * 1000).cast("bigint")
    entries = F.array_sort(F.map_entries(F.coalesce("attributes", F.create_map().cast("map<string,string>"))))
    attributes = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    position = F.col("position") if "position" in samples.columns else F.lit(0)
    parts = ["machine_id", "name", attributes, millis.cast("string"), position.cast("string")]
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    head = F.lpad(F.lower(F.hex(millis)), 12, "0")
    # The two top bits of this digit are the variant, 10.
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 4, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return samples.withColumn(
        "metric_id",
        F.concat(
            F.substring(head, 1, 8),
            F.lit("-"),
            F.substring(head, 9, 4),
            F.lit("-7"),
            F.substring(digest, 1, 3),
            F.lit("-"),
            variant,
            F.substring(digest, 5, 3),
            F.lit("-"),
            F.substring(digest, 8, 12),
        ),
    )


def invalid_by_kind(rejected: DataFrame) -> DataFrame:
    """Rejected bodies counted by what they should have been: `kind` is `metrics` or `machine`."""
    return rejected.groupBy("kind").agg(F.count("*").alias("invalid"))
