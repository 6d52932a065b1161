"""Case tables: filters, grouping, unions of sources, first-row deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.values import contains_any

#: Groups and their keywords, the first match in this order wins.
SURGERY_GROUPS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Thoracic_Surgery", ("thorac", "vats", "lung", "chest", "pulmonary", "mediast")),
    ("Neurosurgery", ("neuro", "brain", "crani", "spine", "intracran", "cns")),
    ("General_Surgery", ("general", "gastric", "colon", "rect", "hep", "chole", "pancre", "hernia")),
    ("Urology", ("uro", "kidney", "renal", "bladder", "prostate")),
    ("Gynecology", ("gyn", "hyster", "ovary", "uter", "obstet")),
    ("Orthopedics", ("ortho", "joint", "hip", "knee", "fracture", "arthro", "spine")),
    ("Cardiac_Surgery", ("cardiac", "cabg", "valve", "aorta", "bypass")),
)


def long_enough(duration: Column, least: float) -> Column:
    """Unknown durations stay."""
    return duration.isNull() | (duration >= least)


def in_departments(department: Column, keys: list[str]) -> Column:
    """True without keys; else the lower-cased department contains one."""
    return F.lit(True) if not keys else contains_any(F.lower(F.coalesce(department, F.lit(""))), [k.strip().lower() for k in keys])


def group_of(department: Column, operation: Column, groups=SURGERY_GROUPS) -> Column:
    """The first group with a keyword in department and operation; else the department's name; else Other."""
    text = F.lower(F.concat_ws(" ", F.coalesce(department, F.lit("")), F.coalesce(operation, F.lit(""))))
    out = None
    for name, words in groups:
        hit = contains_any(text, list(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(department, F.lit("")), r"[^\p{L}\p{N}]+", "_"), r"^_+|_+$", "")
    rest = F.when(plain != "", F.concat(F.lit("Dept_"), plain)).otherwise("Other")
    return rest if out is None else out.otherwise(rest)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in a stated order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in a stated order; 0 means all."""
    return df.orderBy(*order).limit(n) if n > 0 else df


def tagged_union(parts: dict[str, DataFrame], tag: str = "source_dataset") -> DataFrame:
    """All columns of all parts, NULL where a part lacks one, with the part's name."""
    out = None
    for name, df in parts.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def select_cases(cases: DataFrame, order: str, least_duration: float = 30.0, most: int = 0, departments: list[str] | None = None, keep_sources: bool = False) -> DataFrame:
    """Duration filter, then the first ``most`` rows, then departments, then the first row of each case, with its group."""
    df = cases.filter(long_enough(F.col("ane_dur"), least_duration)) if "ane_dur" in cases.columns else cases
    df = first_rows(df, most, [order])
    if departments and "department" in df.columns:
        df = df.filter(in_departments(F.col("department"), departments))
    keys = ["caseid", "source_dataset"] if keep_sources and "source_dataset" in df.columns else ["caseid"]
    df = keep_first(df, keys, [order])
    have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    return df.withColumn("surgery_group", group_of(have("department"), have("opname")))
