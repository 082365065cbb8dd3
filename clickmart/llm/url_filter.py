"""Operator 9: URL verdicts from rules and a Bloom filter cascade.

The cascade answers membership in a list of domains and urls exactly, for
every key of a known universe, from a few bits per listed key.  Level 1
encodes the list itself; level 2 encodes the unlisted keys of the universe
that pass level 1 (only keys that pass are compared with the list); level 3
the listed keys that pass level 2; and so on until no false positive is left.
A key's first failing level tells whether it is listed.  Pages are then judged
in their own tasks: no join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm._store import materialize, without

#: Fixed values of the contract: (rule, verdict); a rule is host + path prefix.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
OUT = ("host", "path", "rule", "verdict")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits the host or a parent of it and the path's start; else null."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: -len(r[0])):
        domain, _, prefix = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return out.otherwise(F.lit(None).cast("string")) if out is not None else F.lit(None).cast("string")


def domains_of(host: Column) -> Column:
    """The host and all its parent domains (an empty host has none)."""
    labels = F.split(host, r"\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)),
                    lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def keys_of(host: Column, path: Column) -> Column:
    """All keys that may be listed: the host, its parent domains, and host + path if there is a path."""
    return F.when((host == "") | (path == ""), domains_of(host)).otherwise(F.array_append(domains_of(host), F.concat(host, path)))


@dataclass(frozen=True)
class Level:
    bits: np.ndarray  # uint64 words
    n_bits: int
    n_hashes: int


def _spots(key: np.ndarray, level: int, n_bits: int, n_hashes: int) -> Iterator[np.ndarray]:
    from clickmart.llm._words import mix
    with np.errstate(over="ignore"):
        for j in range(n_hashes):
            yield mix(key + np.uint64((level * 64 + j + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(n_bits)


def passes(key: np.ndarray, level: int, f: Level) -> np.ndarray:
    """Which 64-bit keys a level's filter holds."""
    ok = np.ones(len(key), bool)
    for s in _spots(key, level, f.n_bits, f.n_hashes):
        ok &= (f.bits[(s >> np.uint64(6)).astype(np.int64)] >> (s & np.uint64(63)) & np.uint64(1)).astype(bool)
    return ok


def listed(key: np.ndarray, cascade: list[Level]) -> np.ndarray:
    """Exact membership of universe keys: listed if the first failing level is an even one
    (or, when none fails, if the last level encodes listed keys)."""
    out = np.full(len(key), len(cascade) % 2 == 1)
    open_ = np.ones(len(key), bool)
    for i, f in enumerate(cascade):
        hit = passes(key, i, f)
        out[open_ & ~hit] = i % 2 == 1
        open_ &= hit
    return out


def _filter(keys: DataFrame, level: int, n_bits: int, n_hashes: int) -> Level:
    """Bloom filter of the column ``h``: each task sets bits in its own copy, copies are OR-ed by word."""
    n_words = -(-n_bits // 64)

    def bits(batches):
        words = np.zeros(n_words, np.uint64)
        for b in batches:
            key = b["h"].to_numpy().astype(np.int64).view(np.uint64)
            for s in _spots(key, level, n_bits, n_hashes):
                np.bitwise_or.at(words, (s >> np.uint64(6)).astype(np.int64), np.uint64(1) << (s & np.uint64(63)))
        at = np.flatnonzero(words)
        yield pd.DataFrame({"word": at, "bits": words[at].view(np.int64)})

    got = keys.mapInPandas(bits, "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toPandas()
    words = np.zeros(n_words, np.uint64)
    words[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return Level(words, n_bits, n_hashes)


def build_cascade(listing: DataFrame, universe: DataFrame, max_filter_bytes: int = 64 << 20, max_levels: int = 64) -> list[Level]:
    """Cascade of a list over a universe (both: h long, a distinct key's hash).

    Listed keys outside the universe do no harm.  The first level's
    false-positive rate is sqrt(1/2) * listed / others, all later ones' 1/2,
    which makes the whole about 2 to 3 bits per listed key plus the logarithm
    of others / listed.  Raises if a level would exceed ``max_filter_bytes``
    on the driver; then build per slice (see ``judge``).
    """
    levels: list[Level] = []
    left = {True: listing.count(), False: universe.count()}
    sides = {True: listing, False: universe}
    while left[side := len(levels) % 2 == 0] or not levels:
        rate = 0.5 if levels else min(0.5, math.sqrt(0.5) * max(left[True], 1) / max(left[False], 1))
        n_hashes = max(1, round(-math.log2(rate)))
        n_bits = max(64, math.ceil(left[side] * n_hashes / math.log(2)))
        if n_bits // 8 > max_filter_bytes:
            raise ValueError(f"a filter of {n_bits // 8} bytes exceeds max_filter_bytes; use more slices")
        i = len(levels)
        levels.append(f := _filter(sides[side], i, n_bits, n_hashes))
        if len(levels) > max_levels:
            raise RuntimeError("the cascade does not end: two keys have the same 64-bit hash")

        @F.pandas_udf("boolean")
        def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for h in batches:
                yield pd.Series(passes(h.to_numpy().astype(np.int64).view(np.uint64), i, f))

        passed = sides[not side].where(hits("h"))
        if not i:  # the universe still holds the listed keys; those that passed are told apart here
            passed = passed.join(listing, "h", "left_anti")
        sides[not side] = materialize(passed, f"cascade-{i}")
        left[not side] = sides[not side].count()
    return levels


def judge(pages: DataFrame, listing: DataFrame, rules=RULES, n_slices: int = 1,
          max_filter_bytes: int = 64 << 20) -> DataFrame:
    """Every row of ``pages`` (page_id, url, any others) with host, path, rule and verdict.

    The longest fitting rule decides.  Without one the verdict is 'block' if
    ``listing`` (domain string) has the host, a parent of it, or host + path,
    else 'allow'.  An entry with a ``/`` is a url (host + path, the path as it
    stands), one without is a domain; A-Z in an entry's host are lower-cased.
    Null url or one without ``://``: empty host and path, no rule, 'allow'.
    Null, empty and repeated entries are ignored; repeated page rows are judged
    alike; input columns named like an output are replaced.  An empty table
    gives no rows, an empty list lists nothing.

    The key universe is every domain and every host + path of the pages, so
    membership is exact for each of them.  A list whose filters would not fit
    ``max_filter_bytes`` is cut into ``n_slices``: pages and urls by a hash of
    host + path, so that a hot host is spread; domains are in every slice.
    Each slice has its own cascade and its own pass over its pages.
    """
    spark = pages.sparkSession
    base = without(pages, *OUT).withColumn("__url", F.col("url"))
    host, path = host_and_path(F.col("__url"))
    base = base.withColumn("host", host).withColumn("path", path).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))

    def slice_of(url: Column) -> Column:
        return F.pmod(F.xxhash64(url), F.lit(n_slices))

    page = F.concat("host", "path")
    universe = materialize(
        base.select("host", "path").distinct().select(slice_of(page).alias("slice"), F.explode(keys_of(F.col("host"), F.col("path"))).alias("d"))
        .select("slice", F.xxhash64("d").alias("h")).distinct(), "url-universe")
    cut = F.instr("domain", "/")
    entry = F.when(cut == 0, F.translate("domain", UPPER, LOWER)).otherwise(
        F.concat(F.translate(F.substring_index("domain", "/", 1), UPPER, LOWER), F.expr("substring(domain, instr(domain, '/'))")))
    slices = F.when(cut == 0, F.sequence(F.lit(0), F.lit(n_slices - 1)).cast("array<long>")).otherwise(F.array(slice_of(entry)))
    names = materialize(listing.where("domain <> ''").select(F.explode(slices).alias("slice"), F.xxhash64(entry).alias("h")).distinct(),
                        "url-list")
    verdicts = {v: [r for r, x in rules if x == v] for v in ("allow", "block")}
    parts = []
    for s in range(n_slices):
        of_slice = F.col("slice") == s
        shared = spark.sparkContext.broadcast(
            build_cascade(names.where(of_slice).select("h"), universe.where(of_slice).select("h"), max_filter_bytes))

        @F.pandas_udf("boolean")
        def any_listed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for lists in batches:
                n = np.array([len(x) for x in lists], np.int64)
                flat = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64).view(np.uint64)
                hit = np.concatenate([[0], np.cumsum(listed(flat, shared.value))])
                end = np.cumsum(n)
                yield pd.Series(hit[end] > hit[end - n])

        part = base if n_slices == 1 else base.where(slice_of(page) == s)
        hashes = F.transform(keys_of(F.col("host"), F.col("path")), lambda d: F.xxhash64(d))
        parts.append(part.withColumn("verdict", F.when(F.col("rule").isin(verdicts["allow"]), "allow")
                                     .when(F.col("rule").isin(verdicts["block"]), "block")
                                     .when(any_listed(hashes), "block").otherwise("allow")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*without(pages, *OUT).columns, *OUT)
