"""Explanatory notes and transaction descriptions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwork.functions.text import code, joined, like_pattern, trimmed
from duskwork.operators.durable import reuse
from duskwork.operators.joins import all_combinations, pattern_matches
from duskwork.operators.lookup import Step, cascade_lookup, choose_pattern, chunk_scan
from duskwork.operators.mutate import merge_upsert
from duskwork.operators.ranking import first_per_key
from duskwork.operators.roles import union_distinct
from duskwork.plans.job import JobResult, Tables
from duskwork.sources.codes import (
    ANY_BATCH, ANY_FREQUENCY, ITEM_COMPANIES, ITEM_PREFIX, MAIN_COVERAGE, MAIN_RIDER, NO_PREMIUM_INDICATOR,
    NOTE_COMPANIES, NOTE_PATTERN_HEAD, OPEN_END, SEGMENT_CODE_WIDTH, SEGMENT_WIDTH, VALID_CONTRACT,
)

# --- fixed values ---
NOTES_LOG_NAME = "RefreshExpNotes"
DESCRIPTIONS_LOG_NAME = "TrxDescription"
NOTE_KEY = ["chdrcoy", "billfreq", "crtable", "noteitem"]
DESCRIPTION_KEY = ["cnttype", "unityp", "batctrcde", "sacstyp"]


def items(lookup: DataFrame) -> DataFrame:
    return lookup.where((F.col("itempfx") == ITEM_PREFIX) & F.col("itemcoy").isin(*ITEM_COMPANIES))


def note_keys(tables: Tables) -> DataFrame:
    """Every coverage code with every payment frequency and company."""
    main = F.col("chdrcoy").isin(*ITEM_COMPANIES) & (F.col("coverage") == MAIN_COVERAGE) & (F.col("rider") == MAIN_RIDER)
    coverages = union_distinct(
        tables["ifsdmcovrpf"].where(main & (F.col("validflag") == VALID_CONTRACT)).select("crtable"),
        tables["ifsdmcovtpf"].where(main).select("crtable"),
    )
    frequencies = tables["ifsdmt3590"].select(code("itemitem").alias("billfreq")).distinct()
    company = F.explode(F.array(*[F.lit(c) for c in NOTE_COMPANIES])).alias("chdrcoy")
    return all_combinations(coverages, frequencies).select("crtable", "billfreq", company)


def premium_indicators(tables: Tables) -> DataFrame:
    """Indicator per company and coverage that has exactly one open item."""
    open_items = tables["ifsdmt5687"].where(F.col("itmto") == OPEN_END)
    return (
        open_items.groupBy(F.col("itemcoy").alias("chdrcoy"), code("itemitem").alias("crtable"))
        .agg(F.count(F.lit(1)).alias("__rows"), F.max("sp_ind").alias("sp_ind"))
        .where(F.col("__rows") == 1).select("chdrcoy", "crtable", "sp_ind", F.lit(True).alias("__single"))
    )


def refresh_notes(tables: Tables, as_of: datetime) -> JobResult:
    """Notes per coverage, frequency and company: the item pattern with the
    frequency where one exists, otherwise the pattern for any frequency. Of several items
    for one note the smallest (company, item) counts; a NULL note text is a key like any other."""
    keys = note_keys(tables).withColumn("__code", code("crtable"))
    single = premium_indicators(tables).withColumnRenamed("crtable", "__code")
    keys = keys.join(single, ["chdrcoy", "__code"], "left")
    indicator = F.when(F.col("__single"), F.col("sp_ind")).otherwise(NO_PREMIUM_INDICATOR)
    keys = keys.select(
        "crtable", "billfreq", "chdrcoy",
        like_pattern(NOTE_PATTERN_HEAD, F.col("billfreq"), indicator, "%").alias("specific"),
        like_pattern(f"{NOTE_PATTERN_HEAD}{ANY_FREQUENCY}", indicator, "%").alias("generic"),
    )
    lookup = items(tables["ifsdmt9065"])
    chosen, pairs = choose_pattern(reuse(keys), "specific", "generic", lookup, "itemitem", "chosen", prefix=True)
    texts = lookup.select("itemitem", "itemcoy", trimmed("longdesc").alias("noteitem"), trimmed("trandesc").alias("notedesc"))
    notes = chosen.join(pairs.join(texts, "itemitem"), "chosen")
    source = reuse(first_per_key(notes, NOTE_KEY, ["itemcoy", "itemitem", "notedesc"]).select(*NOTE_KEY, "notedesc"))
    values = {c: F.col(c) for c in source.columns}
    new = merge_upsert(tables["r_explanatory_notes"], source, NOTE_KEY, {"notedesc": F.col("notedesc")}, values, null_safe=True)
    return JobResult({"r_explanatory_notes": new}, (NOTES_LOG_NAME,))


def type_combinations(tables: Tables) -> DataFrame:
    """Distinct (contract, unit, batch, sub-account) type combinations in use."""
    contracts = tables["ifsdmchdrpf"].select("chdrcoy", "chdrnum", "cnttype").distinct()
    held = tables["ifsdmlzubpf"].select("chdrcoy", "chdrnum", "vrtfnd", "unityp").distinct()
    traded = tables["ifsdmutrnpf"].select("chdrcoy", "chdrnum", "vrtfnd", "batctrcde", "sacstyp").distinct()
    units = held.join(traded, ["chdrcoy", "chdrnum", "vrtfnd"]).drop("vrtfnd").distinct()
    other = tables["ifsdmlzsdpf"].select("chdrcoy", "chdrnum", "unityp", "batctrcde", "sacstyp")
    per_contract = units.select("chdrcoy", "chdrnum", "unityp", "batctrcde", "sacstyp").unionByName(other.distinct())
    return contracts.join(per_contract, ["chdrcoy", "chdrnum"]).select(*DESCRIPTION_KEY).distinct()


def by_pattern(keys: DataFrame, pattern: str, lookup: DataFrame, value: Column) -> Step:
    """Cascade step: lookup rows whose item matches the key's pattern, smallest
    company and item first."""
    pairs = pattern_matches(keys, pattern, lookup, "itemitem")
    return Step(pairs.join(lookup, "itemitem"), (pattern,), value, ("itemcoy", "itemitem"))


def by_segment(keys: DataFrame, pattern: str, needle: str, lookup: DataFrame, count: int | None = None) -> Step:
    """Cascade step over long texts: a segment of a matching item's text that
    names the needle points, by its first characters, to the item that counts. The
    whole text is cut, unless ``count`` says how many segments a layout has."""
    wanted = keys.select(pattern, needle).where(F.col(needle).isNotNull()).distinct()
    sources = pattern_matches(wanted, pattern, lookup, "itemitem").join(lookup, "itemitem")
    texts = wanted.join(sources, pattern).select(pattern, needle, "itemcoy", "itemitem", "trandesc")
    hits = chunk_scan(
        texts, "trandesc", F.col(needle), width=SEGMENT_WIDTH, count=count, head=SEGMENT_CODE_WIDTH
    ).withColumn("__target", like_pattern("%", F.col("code"), "%"))
    targets = lookup.select(
        F.col("itemitem").alias("__item"), F.col("itemcoy").alias("__coy"), F.col("trandesc").alias("__text")
    )
    found = hits.join(pattern_matches(hits, "__target", targets, "__item"), "__target").join(targets, "__item")
    return Step(
        found, (pattern, needle), F.col("__text"), ("itemcoy", "itemitem", "segment", "__coy", "__item")
    )


def describe(keys: DataFrame, long_items: DataFrame, short_items: DataFrame, segment_count: int | None = None) -> DataFrame:
    """A description for each type combination, NULL where nothing matches."""
    acc, unit, batch, sub = (F.col(c) for c in DESCRIPTION_KEY)
    keys = keys.select(
        *DESCRIPTION_KEY,
        like_pattern("%", batch, acc, unit, "%").alias("__p1"), joined(batch, sub).alias("__needle"),
        like_pattern("%", batch, sub, unit, "%").alias("__p2"),
        like_pattern(f"%{ANY_BATCH}", sub, unit, "%").alias("__p3"),
        like_pattern(f"%{ANY_BATCH}", sub, "%").alias("__p4"),
        like_pattern("%", batch, "%").alias("__p5"),
    )
    keys = reuse(keys)
    text = F.col("trandesc")
    steps = [
        by_segment(keys, "__p1", "__needle", long_items, segment_count),
        by_pattern(keys, "__p2", long_items, text),
        by_pattern(keys, "__p3", long_items, text),
        by_pattern(keys, "__p4", long_items, text),
        by_pattern(keys, "__p5", short_items, F.col("longdesc")),
    ]
    found = cascade_lookup(keys, steps, "trandesc")
    return found.select(*DESCRIPTION_KEY, trimmed("trandesc").alias("trandesc"))


def refresh_descriptions(tables: Tables, as_of: datetime, segment_count: int | None = None) -> JobResult:
    """Upsert the description of every type combination in use.

    Long texts are searched whole; ``segment_count`` is for a layout with so many slots.
    """
    long_items, short_items = items(tables["ifsdmt9065"]), items(tables["ifsdmt1688"])
    source = reuse(describe(type_combinations(tables), long_items, short_items, segment_count))
    values = {c: F.col(c) for c in source.columns}
    new = merge_upsert(
        tables["r_trx_description"], source, DESCRIPTION_KEY, {"trandesc": F.col("trandesc")}, values, null_safe=True
    )
    return JobResult({"r_trx_description": new}, (DESCRIPTIONS_LOG_NAME,))
