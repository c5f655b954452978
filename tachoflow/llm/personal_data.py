"""Personal data by candidate gradient boosting, in DataFrame and SQL functions only.

1. Base patterns give the spans that always stand: email, ip, card and phone, leftmost and
   without overlap per kind, with their checks (parts of an address up to 255, the card
   checksum, digits of a number).
2. High-recall generators propose further, overlapping spans of the same kinds: addresses
   written with "at" and "dot", parts of longer digit runs, numbers without a country code.
3. A candidate is described by seven small features (576 possible vectors). Those that meet
   a base span of their kind count as positive, those that fail their check or meet one of
   another kind as negative. Spark counts the vectors; boosted trees are fitted on that
   table and a margin per kind is set so that labelled candidates reach PRECISION.
4. Candidates above the margin that touch no base span are added, leftmost first.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.boosting import Row, boost, threshold
from tachoflow.llm.tables import broadcast_if_small, written

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
CUES = r"(?i)(mail|e-mail|contact|write|call|phone|tel|mobile|fax|card|visa|pay|credit|host|server|addr|ip)[a-z]*[^a-z0-9]{0,8}$"
FEATURES = ("kind", "form", "valid", "before", "after", "cue", "seps")
DOMAINS = (4, 3, 2, 2, 2, 2, 3)

_LOCAL = r"[A-Za-z0-9._%+-]"
_OCTETS = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Base patterns. Quantifiers are possessive where giving back cannot help, and a match
# starts at the start of its run or where the last one ended, so long runs stay linear.
# A card pattern matches maximal digit runs of the right length only: greedy leftmost
# matching takes whole runs, so the others would be dropped anyway.
BASE = (
    ("email", "@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", ".", rf"(?:(?<![0-9])|\G){_OCTETS}"),
    ("card", "", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])"),
    ("phone", "+", r"\+[0-9][ ().0-9-]+[0-9]"),
)


class Generator(NamedTuple):
    kind: str
    form: int
    needs: str
    pattern: str


_AT, _DOT = r"(?:\s?[\[({]\s?at\s?[\])}]\s?)", r"(?:\s?[\[({]\s?dot\s?[\])}]\s?)"
GENERATORS = (
    Generator("email", 0, "@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++ ?@ ?[A-Za-z0-9-]++(?: ?\.[A-Za-z0-9-]++)++"),
    Generator("email", 1, "at", rf"(?i)(?<!{_LOCAL}){_LOCAL}{{1,64}}+{_AT}[A-Za-z0-9-]++(?:(?:\.|{_DOT}| dot )[A-Za-z0-9-]++)++"),
    Generator("email", 2, " at ", rf"(?i)(?<!{_LOCAL}){_LOCAL}{{1,64}}+ at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++"),
    Generator("ip", 0, ".", rf"(?<![0-9.]){_OCTETS}(?!\.?[0-9])"),
    Generator("ip", 1, ".", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    Generator("card", 0, "", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    Generator("card", 1, "", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])"),
    Generator("card", 2, "", r"(?<![0-9])3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])"),
    Generator("phone", 0, "+", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"),
    Generator("phone", 1, "", r"(?<![0-9+.-])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    Generator("phone", 2, "", r"(?<![0-9+.-])[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}(?![0-9.-])"),
)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum of card numbers."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))),
    )
    return F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, found: Column) -> Column:
    """The check of a kind on the text of a span."""
    if kind == "email":
        return found.rlike(r"[A-Za-z]{2,}$")
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda x: F.coalesce(x.try_cast("bigint") <= 255, F.lit(False)))
    digits = _digits(found)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    return F.length(digits).between(8, 15)


def _base_check(kind: str, found: Column) -> Column:
    return F.lit(True) if kind == "email" else valid(kind, found)


def _matched(df: DataFrame, name: str, pattern: str, needs: str) -> DataFrame:
    """Add an array of (found, before, after, start, end) of all matches of a pattern in ``text``.

    The pieces between matches give the positions, in code points.
    """
    search = F.col("digits") if not needs else F.contains("text", F.lit(needs))
    if needs in (".", "+"):
        search = search & F.col("digits")
    df = df.withColumn("hits", F.when(search, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    df = df.withColumn("gaps", F.when(F.size("hits") > 0, F.split("text", pattern, -1)))
    parts = F.transform("hits", lambda x, i: F.struct(
        x.alias("found"), F.length(F.get("gaps", i)).cast("long").alias("gap"),
        F.right(F.get("gaps", i), F.lit(24)).alias("before"), F.left(F.get("gaps", i + 1), F.lit(1)).alias("after")))
    item = "struct<found:string,before:string,after:string,start:bigint,end:bigint>"
    empty = F.array().cast(f"array<{item}>")
    placed = F.aggregate(
        parts, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["found"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                x["found"].alias("found"), x["before"].alias("before"), x["after"].alias("after"),
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + F.length(x["found"])).alias("end")))).alias("out")),
        lambda acc: acc["out"])
    return df.withColumn(name, F.when(F.size("gaps") > 0, placed).otherwise(empty)).drop("hits", "gaps")


def _spans(docs: DataFrame) -> DataFrame:
    """doc_id with ``base`` (kind, start, end) and ``candidates`` (kind, start, end, features, met)."""
    df = docs.withColumn("digits", F.col("text").rlike("[0-9]"))
    for kind, needs, pattern in BASE:
        df = _matched(df, f"base_{kind}", pattern, needs)
    for k, g in enumerate(GENERATORS):
        df = _matched(df, f"made_{k}", g.pattern, g.needs)
    def checked(k: int, kind: str) -> Column:
        return F.transform(
            F.filter(f"base_{kind}", lambda x: _base_check(kind, x["found"])),
            lambda x: F.struct(F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    base = F.concat(*(checked(k, kind) for k, (kind, _, _) in enumerate(BASE)))
    glued = lambda x: F.coalesce(x.rlike(r"[\p{L}\p{N}_=+-]$"), F.lit(False)).cast("int")

    def described(g: Generator, x: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(g.kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.lit(g.form).alias("form"),
            valid(g.kind, x["found"]).cast("int").alias("valid"), glued(x["before"]).alias("before"), glued(x["after"]).alias("after"),
            F.coalesce(x["before"].rlike(CUES), F.lit(False)).cast("int").alias("cue"),
            F.least(F.lit(2), F.length(F.regexp_replace(x["found"], r"[^ ().-]", ""))).alias("seps"))

    def candidates(k: int, g: Generator) -> Column:
        return F.transform(f"made_{k}", lambda x: described(g, x))

    made = F.concat(*(candidates(k, g) for k, g in enumerate(GENERATORS)))
    return df.select("doc_id", F.xxhash64("text").alias("text_key"), base.alias("base"), made.alias("candidates"))


def _overlaps(x: Column, b: Column) -> Column:
    return (x["start"] < b["end"]) & (b["start"] < x["end"])


def _fitted(found: DataFrame, precision: float) -> str:
    """SQL condition on a candidate ``c``: its margin reaches the least one of its kind."""
    one = found.where(F.size("candidates") > 0).select("base", F.explode("candidates").alias("c"))
    same = F.exists("base", lambda b: (b["kind"] == F.col("c.kind")) & _overlaps(F.col("c"), b))
    other = F.exists("base", lambda b: (b["kind"] != F.col("c.kind")) & _overlaps(F.col("c"), b))
    label = F.when((F.col("c.valid") == 0) | (other & ~same), 0).when(same, 1)
    # At most 576 rows: one for each feature vector.
    table = one.select("c.*", label.alias("label")).where("label is not null").groupBy(*FEATURES).agg(
        F.sum("label").alias("positive"), F.sum(1 - F.col("label")).alias("negative")).orderBy(*FEATURES).collect()
    rows = [Row(tuple(int(r[f]) for f in FEATURES), float(r.positive), float(r.negative)) for r in table]
    bias, trees = boost(rows, DOMAINS)
    margin = lambda r: bias + sum(t.score(r.features) for t in trees)
    least = [threshold([(margin(r), r.positive, r.negative) for r in rows if r.features[0] == k], precision) for k in range(len(KINDS))]
    names = [f"c.{f}" for f in FEATURES]
    score = " + ".join([f"{bias!r}D", *(t.sql(names) for t in trees)])
    bounds = " ".join(f"when {k} then {min(x, 1e300)!r}D" for k, x in enumerate(least))
    return f"({score}) >= (case c.kind {bounds} end)"


def personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """All spans of personal data in every text.

    ``docs`` has doc_id and text; other columns are ignored. Returns one row per row: doc_id,
    ``base`` (the spans that the base patterns find) and ``spans`` (these and the added ones),
    arrays of (kind, start, end) ordered by kind as in KINDS and start; positions count code
    points from 0, ends are exclusive. ``text_key`` is a hash of the text, for ``redacted``.

    Null and empty texts have empty arrays. Repeated rows are treated alike. Without
    candidates, or with labels of one sort only, nothing is added for the kind.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = written(_spans(docs), "spans")
    accepted = _fitted(found, precision)
    span = "struct<kind:int,start:bigint,end:bigint>"
    # Leftmost and longest first; a candidate that touches an accepted one of its kind is passed over.
    added = F.expr(f"""aggregate(
      array_sort(transform(filter(candidates, c -> {accepted} and not exists(base, b -> b.start < c.end and c.start < b.end)),
        c -> struct(c.kind as kind, c.start as start, -c.end as last))),
      struct(-1 as kind, -1L as till, cast(array() as array<{span}>) as out),
      (acc, c) -> if(c.kind = acc.kind and c.start < acc.till, acc,
        struct(c.kind as kind, -c.last as till, concat(acc.out, array(struct(c.kind as kind, c.start as start, -c.last as end))) as out)),
      acc -> acc.out)""")
    return found.select("doc_id", "text_key", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", F.when(F.size("candidates") > 0, added).otherwise(F.array().cast(f"array<{span}>")))).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents with every span of their text replaced by its kind in brackets.

    Overlapping spans become one mark, named by the first. ``spans`` is what ``personal_data``
    gives for these documents; rows are matched by doc_id (a missing one too) and text.
    """
    own = spans.where(F.size("spans") > 0).select(F.col("doc_id").alias("span_id"), "text_key", F.col("spans").alias("marked"))
    own = broadcast_if_small(written(own.dropDuplicates(["span_id", "text_key"]), "marked"), 256)
    pieces = F.expr("""aggregate(
      array_sort(transform(marked, s -> struct(s.start as start, s.end as end, s.kind as kind))),
      struct(0L as at, '' as out),
      (acc, s) -> if(s.start < acc.at, struct(greatest(acc.at, s.end) as at, acc.out as out),
        struct(s.end as at, concat(acc.out, substr(text, cast(acc.at + 1 as int), cast(s.start - acc.at as int)), '[', element_at(array('EMAIL', 'IP', 'CARD', 'PHONE'), s.kind + 1), ']') as out)),
      acc -> concat(acc.out, substr(text, cast(acc.at + 1 as int))))""")
    same = F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.xxhash64("text") == F.col("text_key"))
    met = docs.join(own, same, "left")
    return met.withColumn("text", F.when(F.col("marked").isNull(), F.col("text")).otherwise(pieces)).select(*docs.columns)
