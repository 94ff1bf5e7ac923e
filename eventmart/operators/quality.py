"""Record rules, schema codes, accept/reject split, batch reports and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import named, once
from eventmart.functions.columns import event_time as strict_time
from eventmart.sources import schema as S


def event_time(text: Column) -> Column:
    """The contract takes a bare date for a time too."""
    return strict_time(text, whole=False)


def _has(path: str) -> Column:
    return F.coalesce(F.length(path) > 0, F.lit(False))


def _known(path: str, values: list[str]) -> Column:
    return F.coalesce(F.col(path).isin(values), F.lit(False))


def _within(path: str, low: float, high: float) -> Column:
    return F.col(path).isNull() | F.col(path).between(low, high)


def schema_codes() -> Column:
    """Codes of a typed record's violations of the event contract, in order."""
    return named(**{
        "missing:occurred_at": ~_has("occurred_at"),
        "missing:event_type": ~_has("event_type"),
        "missing:product": F.col("product").isNull(),
        "missing:customer": F.col("customer").isNull(),
        "invalid_format:occurred_at": _has("occurred_at") & event_time(F.col("occurred_at")).isNull(),
        "missing:product.product_id": F.col("product").isNotNull() & ~_has("product.product_id"),
        "out_of_range:product.price": ~_within("product.price", 0, S.MAX_PRICE),
        "out_of_range:order.quantity": ~_within("order.quantity", 1, S.MAX_QUANTITY),
        "out_of_range:order.discount_pct": ~_within("order.discount_pct", 0, 100),
        "out_of_range:order.net_amount": F.coalesce(F.col("order.net_amount") < 0, F.lit(False)),
    })


def vocabulary_codes() -> Column:
    """Codes of values outside the controlled vocabularies; empty values pass."""
    return named(**{f"unknown_value:{f}": _has(f) & ~_known(f, v) for f, v in VOCABULARIES.items()})


def schema_errors(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumn("errors", F.concat(schema_codes(), vocabulary_codes()) if strict else schema_codes())


def json_errors(column: str = "body", strict: bool = False) -> Column:
    """The codes of a record still in JSON text, with the type codes that a declared schema would hide.

    The text is parsed once for each record, and each field is then taken from it once.
    """
    return once(F.try_parse_json(column), lambda v: once(_json_facts(v, strict), lambda r: _json_codes(r, strict)))


# Parts of a record that are objects, fields that a record must have, bounded numbers (least, most, type) and vocabularies.
OBJECTS = ("product", "customer", "order", "session", "device", "geo")
NEEDED = ("occurred_at", "event_type", "product", "customer")
#: A field that needed objects mostly hold.
FIRST = {"product": "product_id", "customer": "customer_id"}
BOUNDED = {"product.price": (0.0, float(S.MAX_PRICE), "double"), "order.quantity": (1, S.MAX_QUANTITY, "int"), "order.discount_pct": (0.0, 100.0, "double"), "order.net_amount": (0.0, None, "double")}
VOCABULARIES = {"order.currency": S.CURRENCIES, "order.payment_method": S.PAYMENT_METHODS, "event_type": S.EVENT_TYPES, "channel": S.CHANNELS, "device.type": S.DEVICE_TYPES, "customer.segment": S.CUSTOMER_SEGMENTS}


def _json_facts(v: Column, strict: bool) -> Column:
    """What the codes are made of, as a struct: kinds ("kind:" and a path) and texts ("text:" and a path) of a record's fields.

    Objects are told by a cast that asks for none of their fields, and those that hold FIRST are not written out as text:
    to print their schemas and texts takes several times as long as to parse the record.
    """
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    is_object = lambda path: get(path, "struct<>").isNotNull()
    scalar = lambda path: F.coalesce(F.schema_of_variant(get(path, "variant")), F.lit("VOID"))
    texts = dict.fromkeys([*NEEDED, "product.product_id", *BOUNDED, *(VOCABULARIES if strict else ())])
    return F.struct(
        is_object("$").alias("is_object"),
        *[F.when(is_object(f"$.{path}"), "OBJECT").otherwise(scalar(f"$.{path}")).alias(f"kind:{path}") for path in (*OBJECTS, "occurred_at")],
        *[(F.when(get(f"$.{path}.{FIRST[path]}", "variant").isNotNull(), "OBJECT").otherwise(get(f"$.{path}", "string")) if path in FIRST else get(f"$.{path}", "string")).alias(f"text:{path}") for path in texts],
    )


def _json_codes(r: Column, strict: bool) -> Column:
    is_object, kind, text = r["is_object"], (lambda path: r[f"kind:{path}"]), (lambda path: r[f"text:{path}"])
    codes: dict[str, Column] = {"not_a_dict": ~is_object}
    for f in NEEDED:
        codes[f"missing:{f}"] = is_object & (text(f).isNull() | text(f).isin("", "{}", "[]"))
    for b in OBJECTS:
        codes[f"not_an_object:{b}"] = is_object & (kind(b) != "VOID") & ~kind(b).startswith("OBJECT")
    at = text("occurred_at")
    codes["invalid_format:occurred_at"] = (kind("occurred_at") == "STRING") & (at != "") & event_time(at).isNull()
    codes["invalid_type:occurred_at"] = is_object & ~kind("occurred_at").isin("STRING", "VOID")
    codes["missing:product.product_id"] = kind("product").startswith("OBJECT") & F.coalesce(text("product.product_id") == "", text("product.product_id").isNull())
    for path, (low, high, cast) in BOUNDED.items():
        value = text(path).try_cast(cast)
        codes[f"invalid_type:{path}"] = text(path).isNotNull() & value.isNull()
        codes[f"out_of_range:{path}"] = value.isNotNull() & ((value < low) if high is None else ~value.between(low, high))
    if strict:
        for path, values in VOCABULARIES.items():
            codes[f"unknown_value:{path}"] = text(path).isNotNull() & (text(path) != "") & ~text(path).isin(values)
    return named(**codes)


def error_rules() -> dict[str, Column]:
    """Rules that reject a record: true where it passes."""
    return {
        "schema_valid": F.size(schema_codes()) == 0,
        "product_id_present": _has("product.product_id"),
        "timestamp_parseable": event_time(F.col("occurred_at")).isNotNull(),
        "quantity_in_range": _within("order.quantity", 1, S.MAX_QUANTITY),
        "amount_non_negative": F.coalesce(F.col("order.net_amount") >= 0, F.lit(True)),
        "price_in_range": _within("product.price", 0, S.MAX_PRICE),
    }


def warning_rules(as_of: Column) -> dict[str, Column]:
    """Rules that only lower a batch's verdict; as_of: the time that events may exceed by an hour at most."""
    needs_order = F.col("event_type").isin("checkout_started", "order_placed", "order_cancelled", "refund_issued")
    gap = F.abs(F.col("order.gross_amount") - F.coalesce("order.discount_amount", F.lit(0.0)) - F.col("order.net_amount"))
    return {
        "customer_id_present": _has("customer.customer_id"),
        "known_event_type": _known("event_type", S.EVENT_TYPES),
        "known_channel": _known("channel", S.CHANNELS),
        "known_currency": _known("order.currency", S.CURRENCIES),
        "price_present": F.col("product.price").isNotNull(),
        "amount_consistent": F.coalesce(gap < 0.011, F.lit(True)),
        "timestamp_not_in_future": F.coalesce(event_time(F.col("occurred_at")) <= as_of + F.expr("INTERVAL 1 HOUR"), F.lit(True)),
        "session_present": _has("session.session_id"),
        "idempotency_key_present": _has("idempotency_key"),
        "order_event_has_order_id": ~F.coalesce(needs_order, F.lit(False)) | _has("order.order_id"),
    }


def flag(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """df with the arrays errors and warnings of the rules that each record fails; a rule without an answer fails."""
    fails = lambda rules: named(**{n: ~F.coalesce(ok, F.lit(False)) for n, ok in rules.items()})
    return df.withColumns({"errors": fails(error_rules()), "warnings": fails(warning_rules(F.current_timestamp() if as_of is None else as_of))})


def partition(df: DataFrame, rejected_at: Column, as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted records, rejected ones as rejected_at, reasons, warnings, record)."""
    flagged = flag(df, as_of)
    bad = flagged.filter(F.size("errors") > 0)
    return flagged.filter(F.size("errors") == 0).drop("errors", "warnings"), bad.select(rejected_at.alias("rejected_at"), F.col("errors").alias("reasons"), "warnings", F.struct(*df.columns).alias("record"))


# Thresholds of a batch's verdict.
THRESHOLDS = {"min_pass_pct": 95.0, "warn_pass_pct": 99.0, "max_duplicate_pct": 5.0, "min_records": 0}


def report(df: DataFrame, as_of: Column | None = None, duplicates: int = 0, thresholds: dict | None = None) -> DataFrame:
    """One row: records, passed, failed, warned, duplicates, shares, breaches, verdict and the failures of each rule."""
    t = {**THRESHOLDS, **(thresholds or {})}
    names = [*error_rules(), *warning_rules(F.current_timestamp())]
    failed = F.size("errors") > 0
    counts = flag(df, as_of).select("errors", "warnings").agg(
        F.count("*").alias("records"), F.count_if(failed).alias("failed"), F.count_if(~failed & (F.size("warnings") > 0)).alias("warned"),
        *[F.count_if(F.array_contains("errors", n) | F.array_contains("warnings", n)).alias(n) for n in names],
    )
    n = F.col("records")
    pct = lambda c, empty: F.when(n > 0, c * 100.0 / n).otherwise(empty)
    passed, copies = pct(n - F.col("failed"), 100.0), pct(F.lit(duplicates), 0.0)
    breaches = named(min_records=n < t["min_records"], min_pass_pct=passed < t["min_pass_pct"], max_duplicate_pct=copies > t["max_duplicate_pct"])
    verdict = F.when(F.size(breaches) > 0, "fail").when((passed < t["warn_pass_pct"]) | (F.col("warned") > 0), "warn").otherwise("pass")
    return counts.select(
        "records", (n - F.col("failed")).alias("passed"), "failed", "warned", F.lit(duplicates).cast("long").alias("duplicates"), F.round(passed, 2).alias("pass_pct"), F.round(copies, 2).alias("duplicate_pct"),
        breaches.alias("breaches"), verdict.alias("verdict"), F.map_from_arrays(F.array(*[F.lit(x) for x in names]), F.array(*names)).alias("failed_by_rule"),
    )


def batch_verdict(records: int, failed: int, warned: int, duplicates: int = 0, thresholds: dict | None = None) -> dict:
    """pass_pct, breaches and verdict from counts, by the rules of `report`."""
    t = {**THRESHOLDS, **(thresholds or {})}
    passed, copies = (100.0 * (records - failed) / records, 100.0 * duplicates / records) if records else (100.0, 0.0)
    breaches = [name for name, broken in (("min_records", records < t["min_records"]), ("min_pass_pct", passed < t["min_pass_pct"]), ("max_duplicate_pct", copies > t["max_duplicate_pct"])) if broken]
    verdict = "fail" if breaches else "warn" if passed < t["warn_pass_pct"] or warned else "pass"
    return {"pass_pct": round(passed, 2), "breaches": breaches, "verdict": verdict}


def rule_failures(df: DataFrame, as_of: Column | None = None, duplicates: int = 0) -> DataFrame:
    """The report in long form: a row for each rule with its severity, failures and share."""
    severities = F.create_map(*[x for n in error_rules() for x in (F.lit(n), F.lit("error"))])
    r = report(df, as_of, duplicates)
    long = r.select("records", "verdict", F.explode("failed_by_rule").alias("rule", "failed"))
    return long.select("rule", F.coalesce(severities[F.col("rule")], F.lit("warn")).alias("severity"), "failed", F.when(F.col("records") > 0, F.round(F.col("failed") * 100.0 / F.col("records"), 2)).otherwise(0.0).alias("failed_pct"), "verdict")


# Columns whose nulls a batch summary counts.
NULLABLE = ["customer_id", "session_id", "product_name", "category", "product_price", "order_id"]


def summary(raw: DataFrame, cleaned: DataFrame, silver: DataFrame) -> DataFrame:
    """One row about a silver batch: raw, cleaned and silver rows, rows dropped and duplicated, retention, nulls, types, days."""
    return summary_of(raw.agg(F.count("*").alias("raw_records")).crossJoin(cleaned.agg(F.count("*").alias("clean_records"))), silver)


def summary_of(total: DataFrame, silver: DataFrame) -> DataFrame:
    """The same of rows counted before: one row of raw_records and clean_records."""
    facts = silver.agg(F.count("*").alias("processed_records"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NULLABLE], F.countDistinct("partition_date").alias("days"))
    kinds = silver.groupBy("event_type").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "count")))).alias("events_by_type"))
    n = F.col("processed_records")
    return total.crossJoin(facts).crossJoin(kinds).select(
        "raw_records", "processed_records", F.greatest(F.col("raw_records") - n, F.lit(0)).alias("dropped_records"), (F.col("clean_records") - n).alias("duplicate_records"),
        F.when(F.col("raw_records") > 0, F.round(n * 100.0 / F.col("raw_records"), 2)).otherwise(0.0).alias("retention_pct"),
        *[f"null_{c}" for c in NULLABLE], *[F.when(n > 0, F.round(F.col(f"null_{c}") * 100.0 / n, 2)).otherwise(0.0).alias(f"null_pct_{c}") for c in NULLABLE], "days", "events_by_type",
    )


def verdict(row: dict, thresholds: dict | None = None) -> tuple[str, list[str]]:
    """Verdict and breaches of a summary row; thresholds may hold max_null_pct:COLUMN."""
    t = {**THRESHOLDS, **(thresholds or {})}
    raw, found = row["raw_records"], []
    if raw < t["min_records"]:
        found.append("min_records")
    if raw and row["retention_pct"] < t["min_pass_pct"]:
        found.append("min_pass_pct")
    if row["processed_records"] and 100.0 * row["duplicate_records"] / (row["processed_records"] + row["duplicate_records"]) > t["max_duplicate_pct"]:
        found.append("max_duplicate_pct")
    found += [name for name, most in t.items() if name.startswith("max_null_pct:") and row.get(f"null_pct_{name.partition(':')[2]}", 0.0) > most]
    return ("fail" if found else "warn" if raw and row["retention_pct"] < t["warn_pass_pct"] else "pass"), found


class QualityBreach(RuntimeError):
    """A batch whose verdict is fail, where the caller asked to stop on it."""


def enforce(row: dict, thresholds: dict | None = None, stop: bool = True) -> str:
    outcome, breaches = verdict(row, thresholds)
    if outcome == "fail" and stop:
        raise QualityBreach(", ".join(breaches))
    return outcome
