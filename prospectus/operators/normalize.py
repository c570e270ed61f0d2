"""Normalisation (N1-N9): raw record -> nested item, and the flat views of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules
from ..functions.fields import (needs_fallback, norm_degree, norm_level, norm_study_modes,
                                norm_study_modes_array)
from ..functions.text import clean_str, to_float, to_int

FEE = T.StructType([T.StructField("yearly", T.LongType()),
                    T.StructField("sandwich_year", T.LongType()),
                    T.StructField("currency", T.StringType())])
ITEM_SCHEMA = T.StructType([
    T.StructField("university", T.StructType([
        T.StructField("name", T.StringType()), T.StructField("location", T.StringType())])),
    T.StructField("course", T.StructType([
        T.StructField("name", T.StringType()), T.StructField("degree", T.StringType()),
        T.StructField("level", T.StringType()), T.StructField("department", T.StringType()),
        T.StructField("study_mode", T.ArrayType(T.StringType())),
        T.StructField("duration_years", T.DoubleType()),
        T.StructField("start_month", T.StringType())])),
    T.StructField("fees", T.StructType([T.StructField("uk", FEE),
                                        T.StructField("international", FEE)])),
    T.StructField("admission", T.StructType([
        T.StructField("ucas_code", T.StringType()),
        T.StructField("application_deadline", T.StructType([
            T.StructField("main", T.StringType()), T.StructField("late", T.StringType())])),
        T.StructField("entry_requirements", T.StringType()),
        T.StructField("english_requirement", T.StructType([
            T.StructField("ielts", T.DoubleType())]))])),
    T.StructField("metadata", T.StructType([
        T.StructField("url", T.StringType()), T.StructField("scraped_at", T.StringType())])),
])
ITEM_FIELDS = [f.name for f in ITEM_SCHEMA.fields]


def _fee(yearly: Column, sandwich: Column) -> Column:
    return F.struct(yearly.alias("yearly"), sandwich.alias("sandwich_year"),
                    F.lit(rules.CURRENCY).alias("currency"))


def _whole(raw: DataFrame, name: str) -> Column:
    """N2 by the column's type: an integer stays as it is, with its sign."""
    return to_int(F.col(name), integer=isinstance(raw.schema[name].dataType, T.IntegralType))


def _modes(raw: DataFrame) -> Column:
    dt = raw.schema["study_mode"].dataType
    if isinstance(dt, T.ArrayType):
        return norm_study_modes_array(F.col("study_mode"))
    return norm_study_modes(F.col("study_mode"))


def _raw_types(raw: DataFrame) -> dict[str, str]:
    out = {}
    for f in rules.FALLBACK_CORE_FIELDS:
        dt = raw.schema[f].dataType
        out[f] = ("string" if isinstance(dt, T.StringType)
                  else "array" if isinstance(dt, T.ArrayType) else "number")
    return out


def item_columns(raw: DataFrame, university_name: Column, university_location: Column,
                 url: Column, scraped_at: Column, compat_degree: bool = False) -> list[Column]:
    """The five nested parts of an item from a raw-record frame."""
    name = clean_str(F.col("name"))
    return [
        F.struct(university_name.alias("name"), university_location.alias("location")).alias("university"),
        F.struct(name.alias("name"),
                 norm_degree(F.col("degree"), compat_degree).alias("degree"),
                 norm_level(F.col("level")).alias("level"),
                 clean_str(F.col("department")).alias("department"),
                 _modes(raw).alias("study_mode"),
                 to_float(F.col("duration_years")).alias("duration_years"),
                 clean_str(F.col("start_month")).alias("start_month")).alias("course"),
        F.struct(_fee(_whole(raw, "fee_uk_yearly"), _whole(raw, "fee_uk_sandwich")).alias("uk"),
                 _fee(_whole(raw, "fee_intl_yearly"), _whole(raw, "fee_intl_sandwich"))
                 .alias("international")).alias("fees"),
        F.struct(clean_str(F.col("ucas_code")).alias("ucas_code"),
                 F.struct(clean_str(F.col("deadline_main")).alias("main"),
                          clean_str(F.col("deadline_late")).alias("late")).alias("application_deadline"),
                 clean_str(F.col("entry_requirements")).alias("entry_requirements"),
                 F.struct(to_float(F.col("ielts_score")).alias("ielts")).alias("english_requirement"))
        .alias("admission"),
        F.struct(url.alias("url"), scraped_at.alias("scraped_at")).alias("metadata"),
    ]


def normalise(raw: DataFrame, university_name="university_name",
              university_location="university_location", url="url",
              scraped_at: str = "1970-01-01T00:00:00+00:00", keep: list[str] | None = None,
              compat_degree: bool = False) -> DataFrame:
    """Raw records -> items (rows without a clean name are dropped).

    ``scraped_at`` is a parameter (ISO-8601 text) so reruns are reproducible.
    The temp columns ``needs_fallback``, ``raw_description`` and
    ``raw_entry_req`` travel with the item until gap filling drops them.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    keep = keep or []
    return (raw.filter(clean_str(F.col("name")).isNotNull())
            .select(*keep,
                    *item_columns(raw, col(university_name), col(university_location),
                                  col(url), F.lit(scraped_at), compat_degree),
                    needs_fallback(_raw_types(raw)).alias("needs_fallback"),
                    F.col("description").alias("raw_description"),
                    F.col("entry_requirements").alias("raw_entry_req")))


FLAT_COLUMNS = [
    ("university_name", "university.name"), ("university_location", "university.location"),
    ("name", "course.name"), ("degree", "course.degree"), ("level", "course.level"),
    ("department", "course.department"), ("study_mode", "course.study_mode"),
    ("duration_years", "course.duration_years"), ("start_month", "course.start_month"),
    ("fee_uk_yearly", "fees.uk.yearly"), ("fee_uk_sandwich", "fees.uk.sandwich_year"),
    ("fee_intl_yearly", "fees.international.yearly"),
    ("fee_intl_sandwich", "fees.international.sandwich_year"),
    ("ucas_code", "admission.ucas_code"), ("deadline_main", "admission.application_deadline.main"),
    ("deadline_late", "admission.application_deadline.late"),
    ("entry_requirements", "admission.entry_requirements"),
    ("ielts_score", "admission.english_requirement.ielts"),
    ("source_url", "metadata.url"), ("scraped_at", "metadata.scraped_at"),
]


def flatten_item(items: DataFrame, keep: list[str] | None = None, csv_modes: bool = True) -> DataFrame:
    """U6 (+U5): nested item -> flat columns; study modes joined with ','."""
    cols = []
    for alias, path in FLAT_COLUMNS:
        c = F.col(path)
        if alias == "study_mode" and csv_modes:
            c = F.concat_ws(",", c)
        cols.append(c.alias(alias))
    return items.select(*(keep or []), *cols)


def item_struct() -> Column:
    return F.struct(*[F.col(f) for f in ITEM_FIELDS])


def item_to_json(items: DataFrame) -> Column:
    """The whole item as JSON with null fields kept."""
    return F.to_json(item_struct(), {"ignoreNullFields": "false"})
