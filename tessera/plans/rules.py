"""Data rules over uploads: required fields, data types, ranges and members.

A rule names where its values stand in a payload (a metadata field, a
metadata list, every metric's list, or the year header) and what they must
be. All rules are evaluated in one pass over the payloads: each upload gets
one array of checked values, from which the per-file report counts and the
long form explodes only what is violated. No shuffle and no join, however
many rules there are.

A value that is NULL or blank is ``missing`` if its rule requires it, else
it is not judged; a value that breaks its rule is ``invalid``. A field that
holds no list where a list is expected counts as an empty list (``payload_ok``
reports those).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.payload import list_field, meta_field, metric_lists, parse_payload, text_array, year_header

VALUE, LIST, METRICS, YEARS = "value", "list", "metrics", "years"
TEXT, NUMBER, DATE, PATTERN, MEMBER = "text", "number", "date", "pattern", "member"


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    label: str = ""
    source: str = VALUE
    required: bool = False
    low: str | None = None  # numbers and ISO dates, inclusive
    high: str | None = None
    pattern: str | None = None  # whole value
    members: tuple[str, ...] = field(default=())

    def holds(self, value: Column) -> Column:
        if self.kind == TEXT:
            return F.lit(True)
        if self.kind == PATTERN:
            return value.rlike(f"^(?:{self.pattern})\\z")
        if self.kind == MEMBER:
            return value.isin(*self.members)
        if self.kind not in (NUMBER, DATE):
            raise ValueError(f"unknown kind '{self.kind}' of rule '{self.name}'")
        to = "decimal(38,18)" if self.kind == NUMBER else "date"
        typed = value.try_cast(to)
        ok = typed.isNotNull()
        for bound, fits in ((self.low, Column.__ge__), (self.high, Column.__le__)):
            if bound is not None:
                ok = ok & F.coalesce(fits(typed, F.lit(bound).cast(to)), F.lit(False))
        return ok

    def values(self) -> Column:
        """ARRAY<STRUCT<field, position, value>> of this rule's values."""
        if self.source == VALUE:
            return F.array(_item(F.lit(self.label), F.lit(1), F.col("_em")[self.label]))
        if self.source == METRICS:
            return F.flatten(F.transform(F.coalesce(metric_lists(), F.array().cast("array<struct<key:string,value:string>>")),
                                         lambda m: _items(m["key"], text_array(m["value"]))))
        if self.source not in (LIST, YEARS):
            raise ValueError(f"unknown source '{self.source}' of rule '{self.name}'")
        return _items(F.lit(self.label), list_field(self.label) if self.source == LIST else year_header())


def _item(label: Column, position: Column, value: Column) -> Column:
    return F.struct(label.alias("field"), position.cast("int").alias("position"), value.alias("value"))


def _items(label: Column, values: Column) -> Column:
    values = F.coalesce(values, F.array().cast("array<string>"))
    return F.transform(values, lambda v, i: _item(label, i + 1, v))


def _verdicts(rule: Rule) -> Column:
    def judge(item: Column) -> Column:
        empty = item["value"].isNull() | (F.trim(item["value"]) == "")
        verdict = F.when(empty, F.lit("missing") if rule.required else F.lit("empty")).when(rule.holds(item["value"]), F.lit("valid")).otherwise(F.lit("invalid"))
        return F.struct(F.lit(rule.name).alias("rule"), item["field"].alias("field"), item["position"].alias("position"),
                        item["value"].alias("value"), verdict.alias("verdict"))
    return F.transform(rule.values(), judge)


def checked(raw: DataFrame, rules: list[Rule]) -> DataFrame:
    """(upload_id, filename, values): every judged value of each upload."""
    p = parse_payload(raw)
    return p.select("upload_id", meta_field("filename").alias("filename"), F.concat(*[_verdicts(r) for r in rules]).alias("values"))


def violations(raw: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per missing or invalid value."""
    bad = F.filter("values", lambda v: v["verdict"].isin("missing", "invalid"))
    return checked(raw, rules).select("upload_id", "filename", F.explode(bad).alias("v")).select(
        "upload_id", "filename", "v.rule", "v.field", "v.position", "v.value", "v.verdict")


def file_report(raw: DataFrame, rules: list[Rule]) -> DataFrame:
    """R1 per file: judged, missing and invalid values, the share of required
    values that are there and the share of given values that are valid (NULL
    where there are none)."""
    def n(*verdicts: str) -> Column:
        return F.size(F.filter("values", lambda v: v["verdict"].isin(*verdicts))).cast("bigint")
    required = [r.name for r in rules if r.required]
    needed = F.size(F.filter("values", lambda v: v["rule"].isin(*required))).cast("bigint")
    d = checked(raw, rules).select("upload_id", "filename", n("valid").alias("n_valid"), n("invalid").alias("n_invalid"),
                                   n("missing").alias("n_missing"), needed.alias("_needed"))
    given = F.col("n_valid") + F.col("n_invalid")
    return d.select("upload_id", "filename", "n_valid", "n_invalid", "n_missing",
                    F.round(F.try_divide(F.col("_needed") - F.col("n_missing"), F.col("_needed")), 6).alias("completeness"),
                    F.round(F.try_divide(F.col("n_valid"), given), 6).alias("validity"))
