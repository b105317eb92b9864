"""Secret scans: fixed patterns, and windows of high entropy in candidate strings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The base kinds in their order, as the contract states them. The runs
#: are matched from their start on, which finds the same spans without retries.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
LEAST_ASSIGNED = 6

#: Candidates for the entropy scan: long runs of signs that keys are written in.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"

#: Signs per window, and the bits of entropy a sign needs to be taken for a key: in
#: windows of hexadecimal digits and in other ones.
WINDOW = 20
HEX_BITS = 3.0
MIXED_BITS = 3.8

#: Candidates that look like keys but are none.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9_=+/-]+$",  # numbers, dates
    r"^[a-z]{1,15}([-_/]([a-z]{1,15}|[0-9]{1,8}))+$",  # words and numbers with hyphens
    r"^(AKIA[A-Z0-9]{9}|[A-Za-z0-9+/]{30})EXAMPLE(KEY)?$",  # the keys of manuals
)

#: Parts of a candidate that are no key, and their length: words of manuals, alphabets.
#: What stands next to them is judged without them.
MASKED = ((r"(?i)example", 7), (r"(?i)(0123456789|abcdefghij)", 10))

KINDS = ("assign", "access", "hex", "entropy")


def _weights() -> Column:
    """n log2 n for the counts of a window."""
    return F.array(*(F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 2)))


def _hot_span(candidate: Column) -> Column:
    """``(first, last)``: where the hot windows of a candidate begin and end, or -1.

    One pass moves the window along. Entering and leaving signs change one count each,
    and with it the sum of n log2 n, from which the entropy follows; so do the counts of
    digits, of letters and of hexadecimal digits, which tell the window's class.
    """
    weights = _weights()
    signs = F.split(candidate, "")

    def count(sign: Column, window: Column) -> Column:
        return F.length(window) - F.length(F.replace(window, sign, F.lit("")))

    def is_a(sign: Column, pattern: str) -> Column:
        return sign.rlike(pattern).cast("int")

    def step(state: Column, i: Column) -> Column:
        sign = F.element_at(signs, i)
        full = i > WINDOW
        old = F.when(full, F.element_at(signs, F.greatest(i - WINDOW, F.lit(1)))).otherwise("")
        since = F.greatest(i - WINDOW, F.lit(1))
        before = F.array_join(F.slice(signs, since, i - since), "")
        left = F.when(full, F.substring(before, 2, WINDOW)).otherwise(before)
        gone = count(old, before)
        come = count(sign, left)
        total = (
            state["total"]
            + F.when(full, F.get(weights, gone - 1) - F.get(weights, gone)).otherwise(0.0)
            + F.get(weights, come + 1)
            - F.get(weights, come)
        )

        def moved(name: str, pattern: str) -> Column:
            return state[name] + is_a(sign, pattern) - is_a(old, pattern)

        digits, letters = moved("digits", "[0-9]"), moved("letters", "[A-Za-z]")
        hexes = moved("hexes", "[0-9A-Fa-f]")
        bits = F.lit(math.log2(WINDOW)) - total / WINDOW
        hot = (
            (i >= WINDOW)
            & (digits > 0)
            & (letters > 0)
            & (bits >= F.when(hexes == WINDOW, HEX_BITS).otherwise(MIXED_BITS))
        )
        return F.struct(
            total.alias("total"),
            digits.alias("digits"),
            letters.alias("letters"),
            hexes.alias("hexes"),
            F.when(hot & (state["first"] < 0), i - WINDOW).otherwise(state["first"]).alias("first"),
            F.when(hot, i).otherwise(state["last"]).alias("last"),
        )

    start = F.struct(
        F.lit(0.0).alias("total"),
        *(F.lit(0).alias(n) for n in ("digits", "letters", "hexes")),
        *(F.lit(-1).alias(n) for n in ("first", "last")),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.length(candidate)),
        start,
        step,
        lambda state: F.struct(state["first"].alias("first"), state["last"].alias("last")),
    )


def secret_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, kind, start, end)`` of all spans, in code points.

    ``version`` is a hash of the text; ``kind`` counts along ``KINDS``. Entropy spans
    that lie within a base span are left out.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("version", F.xxhash64("text"))
    patterns = (ASSIGN, ACCESS, HEX, CANDIDATE)
    found = texts.select(
        "*",
        *(
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias(f"m{kind}")
            for kind, pattern in enumerate(patterns)
        ),
    )
    nothing = F.array().cast("array<string>")

    def parted(kind: int, pattern: str) -> Column:
        """The matches of one kind, what lies between them, and assigned values."""
        met = F.size(f"m{kind}") > 0
        values = F.lit(None).cast("array<string>")
        if kind == 0:
            values = F.when(met, F.regexp_extract_all("text", F.lit(pattern), F.lit(2)))
        return F.struct(
            F.lit(kind).alias("kind"),
            F.col(f"m{kind}").alias("matches"),
            F.when(met, F.split("text", pattern, -1)).otherwise(nothing).alias("between"),
            values.alias("values"),
        )

    kinds = found.select(
        "doc_id", "version", F.explode(F.array(*map(parted, range(4), patterns))).alias("p")
    )
    rows = kinds.select(
        "doc_id", "version", "p", F.posexplode("p.matches").alias("place", "body")
    ).select(
        "doc_id",
        "version",
        F.col("p.kind").alias("kind"),
        "place",
        F.length(F.get("p.between", F.col("place"))).alias("gap"),
        "body",
        F.get("p.values", F.col("place")).alias("value"),
    )
    # Entropy is computed where the text was read, before the few rows are brought together.
    judged = F.col("body")
    for pattern, length in MASKED:
        judged = F.regexp_replace(judged, pattern, " " * length)
    wanted = (F.col("kind") == 3) & F.col("body").rlike("[0-9]")
    for pattern in ALLOWED:
        wanted &= ~F.col("body").rlike(pattern)
    rows = rows.withColumn("judged", F.when(wanted, judged))
    rows = rows.withColumn("hot", F.when(F.col("judged").isNotNull(), _hot_span(F.col("judged"))))
    rows = rows.drop("judged").dropDuplicates(["doc_id", "version", "kind", "place"])
    along = Window.partitionBy("doc_id", "version", "kind").orderBy("place")
    size = F.length("body")
    start = F.sum(F.col("gap") + size).over(along) - size
    spans = rows.withColumn("start", start)
    base = spans.where(
        (F.col("kind") < 3) & ((F.col("kind") > 0) | (F.length("value") >= LEAST_ASSIGNED))
    ).select("doc_id", "version", "kind", "start", (F.col("start") + size).alias("end"))
    hot = spans.where("hot.last > 0").select(
        "doc_id",
        "version",
        "kind",
        (F.col("start") + F.col("hot.first")).alias("start"),
        (F.col("start") + F.col("hot.last")).alias("end"),
    )
    before = (
        Window.partitionBy("doc_id", "version")
        .orderBy("start", "kind")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    reach = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(before)
    return (
        base.union(hot)
        .withColumn("reach", F.coalesce(reach, F.lit(-1)))
        .where((F.col("kind") < 3) | (F.col("reach") < F.col("end")))
        .drop("reach")
    )


def _written(rows: str, base_only: bool) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    chosen = F.col(rows)
    if base_only:
        chosen = F.filter(chosen, lambda s: s["kind"] < 3)
    return F.array_join(
        F.transform(
            F.array_sort(chosen),
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Base kinds are patterns matched from left to right without overlaps: a name of a
    secret with a value of six signs or more, an access key, a long hexadecimal string.
    To these come windows of high entropy within long strings of key-like signs, unless
    the string is on the allow list; words of manuals and alphabets in it count as blanks.
    A span is ``kind:start:end`` in code points;
    ``base_sha256`` is over the base spans.

    Nulls count as empty texts. Repeated rows get the same result each; rows with one
    doc_id and different texts, or none, get that of their own text.
    """
    spans = secret_spans(docs)
    found = spans.groupBy("doc_id", "version").agg(
        *(
            F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{name}")
            for i, name in enumerate(KINDS[:3])
        ),
        F.collect_list(F.struct("start", "kind", "end")).alias("rows"),
    )
    found = found.select(
        F.col("doc_id").alias("found_id"),
        F.col("version").alias("found_version"),
        *(f"n_{name}" for name in KINDS[:3]),
        _written("rows", True).alias("base"),
        _written("rows", False).alias("spans"),
    )
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (
        F.col("version") == F.col("found_version")
    )
    return rows.join(found, same, "left").select(
        "doc_id",
        *(F.coalesce(f"n_{name}", F.lit(0)).alias(f"n_{name}") for name in KINDS[:3]),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
