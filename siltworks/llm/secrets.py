"""Secret scans, and weak candidates linked to the other parts of a credential.

Column functions only. Strong spans come from patterns. A weak candidate (an identifier, a
bare key, an endpoint) says little alone, so it is reported only if the parts that would
complete a credential start within ``scope`` code points of it.

The link is an interval join on bins as wide as the scope: the parts of a bin are reduced
to their least and greatest start, and a candidate looks at its own bin and the two beside
it. Rows therefore grow with the candidates, never with their pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.frames import let, without
from siltworks.staging import settle

# The kinds in the order in which they are listed, and their patterns.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# Weak kinds: an identifier's assignment, a bare key of 40 characters, an address.
KEY_ID = r"""(?i)(access_?key_?id|client_?id|account_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.-]{6,})"""
BARE_KEY = r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?i)https?://[a-z0-9.-]+(?::[0-9]+)?"

KINDS = ["assign", "access", "hex", "key_id", "bare_key", "endpoint"]
ROLE = {
    "assign": "secret",
    "access": "identifier",
    "hex": "secret",
    "key_id": "identifier",
    "bare_key": "secret",
    "endpoint": "endpoint",
}
# A weak candidate needs one of each group.
NEEDS = {
    "key_id": [["secret"]],
    "bare_key": [["identifier", "endpoint"]],
    "endpoint": [["identifier"], ["secret"]],
}
SCOPE = 256
# Values joined as one, and code points of a text cut as one.
CHUNK = 64
CUT = 4096
MASK = "[SECRET]"
RESULTS = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "secret_spans"]

_SPAN = "array<struct<start:int,rank:int,end:int>>"


def matches(text: Column, pattern: str, rank: int, least: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as (start, rank, end), in code points.

    The text between the matches and the matches themselves alternate, so their lengths
    give all positions. ``least`` is a condition on a match, by lambda variables.
    """
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        *([least.alias("value")] if least is not None else []),
    )

    def span(x: Column, size: Column, start: Column) -> Column:
        keep = x["match"].isNotNull()
        if least is not None:
            keep = keep & (F.length(x["value"]) >= 12)
        end = start + size
        begin = end - F.length(x["match"])
        return F.when(keep, F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))

    def spans(parts: Column) -> Column:
        def listed(sizes: Column, starts: Column) -> Column:
            all_of = F.transform(parts, lambda x, i: span(x, F.get(sizes, i), F.get(starts, i)))
            return F.filter(all_of, lambda x: x.isNotNull())

        lengths = F.transform(
            parts, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))
        )
        return let(
            lengths,
            lambda sizes: let(
                before(sizes, F.lit(0), lambda a, x: a + x), lambda starts: listed(sizes, starts)
            ),
        )

    return F.when(F.rlike(text, F.lit(pattern)), let(zipped, spans).cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def before(values: Column, zero: Column, join) -> Column:
    """For each value of an array that is not empty, all values before it joined.

    ``values`` is a lambda variable; an expression would be computed anew for each value.
    Values are joined in chunks, chunks before a value's own as a whole, so that the steps grow
    little faster than the array.
    """

    def within(chunks: Column) -> Column:
        ahead = F.transform(chunks, lambda _, c: F.aggregate(F.slice(chunks, 1, c), zero, join))

        def places(start: Column) -> Column:
            def place(_, i):
                chunk = F.floor(i / CHUNK).cast("int")
                own = F.slice(values, chunk * CHUNK + 1, i - chunk * CHUNK)
                return F.aggregate(own, F.get(start, chunk), join)

            return F.transform(values, place)

        return let(ahead, places)

    number = F.floor((F.size(values) - 1) / CHUNK).cast("int")
    sums = F.transform(
        F.sequence(F.lit(0), number),
        lambda c: F.aggregate(F.slice(values, c * CHUNK + 1, CHUNK), zero, join),
    )
    return let(sums, within)


def _longer(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda x: x["end"] - x["start"] >= least)


def base_spans(text: Column) -> Column:
    """Spans of the strong kinds, by start and kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    # A shorter run fails and cannot hide a longer one, so the length is in the pattern.
    return F.array_sort(
        F.concat(
            matches(text, ASSIGN, 0, values),
            matches(text, ACCESS[:-1] + "{14,}", 1),
            matches(text, HEX[:-1] + "{16,}", 2),
        )
    )


def weak_spans(text: Column) -> Column:
    return F.concat(
        matches(text, KEY_ID, 3), matches(text, BARE_KEY, 4), matches(text, ENDPOINT, 5)
    )


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(
                ":", F.get(names, x["rank"]), x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )


def linked(found: DataFrame, scope: int) -> DataFrame:
    """Weak spans that are completed within the scope, in an array for each text.

    ``found`` has the hash of a text as ``_key``, and the arrays ``_base`` and ``_weak``.
    """
    texts = (
        found.filter("_key is not null")
        .groupBy("_key")
        .agg(F.first("_base").alias("_base"), F.first("_weak").alias("_weak"))
    )
    roles = F.array(*(F.lit(ROLE[kind]) for kind in KINDS))
    parts = texts.select("_key", F.explode(F.concat("_base", "_weak")).alias("part")).select(
        "_key",
        "part",
        F.get(roles, F.col("part.rank")).alias("role"),
        F.floor(F.col("part.start") / scope).alias("bin"),
    )
    # One row for each bin of a text, with the reach of every role in it.
    bins = parts.groupBy("_key", "bin").agg(
        *(
            edge(F.when(F.col("role") == role, F.col("part.start"))).alias(f"{label}_{role}")
            for role in ("identifier", "secret", "endpoint")
            for label, edge in (("least", F.min), ("most", F.max))
        )
    )
    weak = parts.filter(F.col("part.rank") >= 3).select(
        "_key", "part", F.explode(F.array(*(F.col("bin") + d for d in (-1, 0, 1)))).alias("bin")
    )
    start = F.col("part.start")

    def near(role: str) -> Column:
        least, most = F.col(f"least_{role}"), F.col(f"most_{role}")
        return F.coalesce(F.max((least <= start + scope) & (most >= start - scope)), F.lit(False))

    reached = (
        weak.join(bins, ["_key", "bin"])
        .groupBy("_key", "part")
        .agg(*(near(role).alias(role) for role in ("identifier", "secret", "endpoint")))
    )
    complete = F.lit(False)
    for kind, groups in NEEDS.items():
        condition = F.col("part.rank") == KINDS.index(kind)
        for group in groups:
            any_of = F.lit(False)
            for role in group:
                any_of = any_of | F.col(role)
            condition = condition & any_of
        complete = complete | condition
    return (
        reached.filter(complete).groupBy("_key").agg(F.collect_list("part").alias("_linked"))
    )


def _found(docs: DataFrame, text: str, keep: Sequence[str], scope: int) -> DataFrame:
    """Columns ``keep``, base spans and all spans of each document, in written tables."""
    value = F.coalesce(F.col(text), F.lit(""))
    spans = docs.select(
        *keep, base_spans(value).alias("_base"), weak_spans(value).alias("_weak"),
        F.sha2(value.cast("binary"), 256).alias("_hash"),
    )
    spans = settle(
        spans.withColumn("_key", F.when(F.size("_weak") > 0, F.col("_hash"))).drop("_hash"),
        "spans",
    )
    links = settle(linked(spans, scope), "links").withColumnRenamed("_key", "_of")
    joined = spans.join(links, spans["_key"] == links["_of"], "left")
    extra = F.coalesce(F.col("_linked"), F.array().cast(_SPAN))
    return joined.select(
        *keep, "_base", F.array_sort(F.concat("_base", extra)).alias("_spans")
    )


def secret_spans(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), scope: int = SCOPE
) -> DataFrame:
    """Secrets of each whole text, with the columns ``keep``.

    Adds ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` (kind:start:end,
    code points, end exclusive), and ``secret_spans`` as structs. These replace kept
    columns of the same names. A null text is empty. Repeated rows stay; equal texts are
    linked once.
    """
    kept = [name for name in without(docs, RESULTS) if name.lower() in {k.lower() for k in keep}]
    narrow = docs.select(
        *(F.col(name).alias(f"_k{i}") for i, name in enumerate(kept)),
        F.col(text).alias("_text"),
    )
    found = _found(narrow, "_text", [f"_k{i}" for i in range(len(kept))], scope)
    names = F.array(*(F.lit(kind) for kind in KINDS))

    def count(rank: int) -> Column:
        return F.size(F.filter("_base", lambda x: x["rank"] == rank)).cast("bigint")

    return found.select(
        *(F.col(f"_k{i}").alias(name) for i, name in enumerate(kept)),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("_spans")).alias("spans"),
        F.transform(
            "_spans",
            lambda x: F.struct(
                F.get(names, x["rank"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")
            ),
        ).alias("secret_spans"),
    )


def redacted(
    docs: DataFrame, text: str = "text", mask: str = MASK, scope: int = SCOPE
) -> DataFrame:
    """All documents and columns, with every secret span replaced by ``mask``.

    Overlapping spans become one mask. A null text stays null.
    """
    columns = docs.columns
    own = [f"_c{i}" for i in range(len(columns))]
    at = [name.lower() for name in columns].index(text.lower())
    body = F.col(own[at])
    found = _found(docs.toDF(*own), own[at], own, scope)

    def between(cuts: Column, start: Column, end: Column) -> Column:
        """A range of the text, from its cuts of equal length, so that no step counts from its start."""
        first, last = F.floor(start / CUT).cast("int"), F.floor(end / CUT).cast("int")
        inside = start - first * CUT + 1
        joined = F.concat(
            F.substring(F.get(cuts, first), inside, F.lit(CUT)),
            F.array_join(F.slice(cuts, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.coalesce(F.substring(F.get(cuts, last), F.lit(1), end - last * CUT), F.lit("")),
        )
        short = F.substring(F.get(cuts, first), inside, end - start)
        return F.when(end <= start, "").when(first == last, short).otherwise(joined)

    def masked(cuts: Column, reached: Column) -> Column:
        """``reached`` is where the spans before each have ended."""

        def part(x, i):
            gap = between(cuts, F.get(reached, i), x["start"])
            return F.when(x["start"] >= F.get(reached, i), F.concat(gap, F.lit(mask))).otherwise("")

        last = F.aggregate("_spans", F.lit(0), lambda a, x: F.greatest(a, x["end"]))
        parts = F.array_join(F.transform("_spans", part), "")
        return F.concat(parts, between(cuts, last, F.length(body)))

    ends = F.transform("_spans", lambda x: x["end"])
    cut = let(
        F.regexp_extract_all(body, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)),
        lambda cuts: let(
            let(ends, lambda values: before(values, F.lit(0), lambda a, x: F.greatest(a, x))),
            lambda reached: masked(cuts, reached),
        ),
    )
    value = F.when(F.size("_spans") > 0, cut).otherwise(body)
    return found.select(
        *((value if i == at else F.col(c)).alias(columns[i]) for i, c in enumerate(own))
    )
