"""Secret scan by sliding-window entropy (operator 13).

Three base rules (assignments of passwords and tokens, access keys, runs of hex digits)
find the spans that always stay. Beside them, every long run of token characters is a
candidate: it is put into the narrowest character class that holds it, and a window of
WINDOW characters slides over it. The Shannon entropy of the window follows from the
counts of its characters, of which each step changes two: the one that enters and the
one that leaves. Windows that reach their class' threshold span the secret, unless the
candidate is on the allow list or overlaps a base span.

The sums are of integers (millionths of c * log2(c)), so that no order of summation
shows. A candidate of any length is cut into blocks that overlap by a window, so no
task holds more than a block. One scan proposes all spans; positions are running sums
of the lengths of matches and of the gaps between them. DataFrame and SQL functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN, ACCESS, HEX, ENTROPY = range(4)
MARKER = -1                  # row that keeps a text without proposals
_ASSIGN = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
_VALUE = r"\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: kind -> (pattern that a text must hold at all, pattern of a span); a run of hex digits
#: is tried at its start, so what the last two find are whole runs.
PATTERNS = {
    ASSIGN: (_ASSIGN, _ASSIGN + _VALUE),
    ACCESS: ("AKIA[A-Z0-9]", "AKIA[A-Z0-9]++"),
    HEX: ("[0-9a-f]{16}", "[0-9a-f]{16,}+"),
    ENTROPY: ("[A-Za-z0-9+/_=-]{20}", "[A-Za-z0-9+/_=-]{20,}+"),
}
LEAST = {ASSIGN: 12, ACCESS: 18, HEX: 16}

WINDOW = 20
BLOCK = 256                  # window starts of a block
UNIT = 1_000_000
#: Character classes, narrowest first, with the bits a character of a window must reach
#: (random hex digits of 20 have 3.3 on average, random letters and digits 4.0).
CLASSES = [("hex", "^[0-9A-Fa-f]+$", 2.9), ("upper", "^[0-9A-Z]+$", 3.5), ("letters", "^[0-9A-Za-z]+$", 3.6), ("base64", "", 3.8)]
#: Candidates that are no secrets: without both letters and digits; UUIDs; placeholders; runs
#: of the alphabet or digits. Paths, slugs and names are told by :func:`plain_words`.
ALLOW = (
    r"^[^0-9]*$", r"^[^A-Za-z]*$",
    r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",
    r"(?i)example|sample|placeholder|changeme|dummy|your[_-]|xxxx",
    r"(?i)abcdefgh|12345678|87654321|qwerty|(.)\1{7}",
)
PIECE = "[A-Z]?[a-z]++|[A-Z]++|[0-9]++"
PIECE_LENGTH = 3.5           # random letters and digits change their kind every 2 characters or so
_PROPOSAL = "array<struct<kind:int,i:int,gap:int,found:string>>"
_SPAN = "struct<kind:int,start:long,end:long>"


def _matches(text: Column, kind: int) -> Column:
    """Array of (kind, place, length of the gap before, found) of a kind's matches in order."""
    holds, pattern = PATTERNS[kind]
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    rows = F.transform(F.filter(zipped, lambda z: z["m"].isNotNull()), lambda z, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(z["g"]).alias("gap"), z["m"].alias("found")))
    return F.when(text.rlike(holds), rows).otherwise(F.array().cast(_PROPOSAL))


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Matches of all patterns (``row, id, kind, start, end, found``) that pass their rule
    or are candidates, and one marker row for every text."""
    marker = F.array(F.struct(F.lit(MARKER).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit("").alias("found")))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    found = F.concat(marker, *[_matches(F.col("text"), k) for k in PATTERNS])
    rows = stored(rows.select("row", "id", F.explode(found).alias("p")).select("row", "id", "p.*"), "secret-matches")
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (rows.repartition("row").withColumn("end", F.sum(F.col("gap") + F.length("found")).over(before))
            .withColumn("start", F.col("end") - F.length("found")))
    value = F.regexp_extract("found", f"^{_ASSIGN}{_VALUE}$", 1)
    passes = (F.when(F.col("kind") == ASSIGN, F.length(value) >= LEAST[ASSIGN])
              .when(F.col("kind") == ACCESS, F.length("found") >= LEAST[ACCESS]).otherwise(F.lit(True)))
    return rows.where(passes).select("row", "id", "kind", "start", "end", "found")


def _limit(found: Column) -> Column:
    """Largest sum of c * log2(c) over a window's characters with which its entropy
    reaches the threshold of the candidate's class."""
    out = None
    for _, pattern, bits in reversed(CLASSES):
        limit = F.lit(math.floor(UNIT * WINDOW * (math.log2(WINDOW) - bits)))
        out = limit if out is None else F.when(found.rlike(pattern), limit).otherwise(out)
    return out


def _steps() -> Column:
    """[c]: by how much c * log2(c) grows when the c-th equal character enters a window."""
    part = [0.0, *(c * math.log2(c) for c in range(1, WINDOW + 1))]
    return F.array(F.lit(0), *[F.lit(round(UNIT * (part[c] - part[c - 1]))) for c in range(1, WINDOW + 1)])


def secret_windows(candidates: DataFrame) -> DataFrame:
    """Candidates (``row, start, found``) to (``row, start, first, last``): the first and the
    last window of each that reaches its class' threshold, as offsets of their starts."""
    blocks = F.sequence(F.lit(0), F.floor((F.length("found") - WINDOW) / BLOCK).cast("int"))
    cut = F.transform(blocks, lambda b: F.struct((b * BLOCK).alias("at"), F.substring(
        F.col("found"), b * BLOCK + 1, F.lit(BLOCK + WINDOW - 1)).alias("s")))
    rows = candidates.select("row", "start", _limit(F.col("found")).alias("limit"), F.explode(cut).alias("b"))
    rows = rows.select("row", "start", "limit", F.col("b.at").alias("at"), F.col("b.s").alias("s"))
    steps = _steps()

    def count(window: Column, at: Column) -> Column:
        """Place of a character's step: how often the window holds the one at ``at``."""
        rest = F.replace(window, F.substring(F.col("s"), at, F.lit(1)), F.lit(""))
        return F.get(steps, F.length(window) - F.length(rest))

    def change(i: Column) -> Column:
        enters = count(F.substring(F.col("s"), F.greatest(i - (WINDOW - 1), F.lit(1)), F.least(i, F.lit(WINDOW))), i)
        leaves = F.when(i > WINDOW, count(F.substring(F.col("s"), i - WINDOW, F.lit(WINDOW)), i - WINDOW)).otherwise(F.lit(0))
        return F.struct((i - WINDOW).alias("at"), (enters - leaves).alias("by"))

    def step(acc: Column, x: Column) -> Column:
        total = acc["total"] + x["by"]
        hit = (x["at"] >= 0) & (total <= F.col("limit"))
        return F.struct(total.alias("total"), F.when(hit, F.coalesce(acc["first"], x["at"])).otherwise(acc["first"]).alias("first"),
                        F.when(hit, x["at"]).otherwise(acc["last"]).alias("last"))

    none = F.lit(None).cast("int")
    start = F.struct(F.lit(0).alias("total"), none.alias("first"), none.alias("last"))
    changes = F.transform(F.sequence(F.lit(1), F.length("s")), change)
    rows = rows.select("row", "start", "at", F.aggregate(changes, start, step).alias("w")).where("w.first is not null")
    return rows.groupBy("row", "start").agg(F.min(F.col("at") + F.col("w.first")).alias("first"),
                                            F.max(F.col("at") + F.col("w.last")).alias("last"))


def plain_words(found: Column) -> Column:
    """Is it made of words and numbers (runs of one kind) of PIECE_LENGTH on average, at least?"""
    return F.length(F.regexp_replace(found, "[^A-Za-z0-9]", "")) >= PIECE_LENGTH * F.regexp_count(found, F.lit(PIECE))


def allowed(found: Column, allow: tuple = ALLOW) -> Column:
    out = plain_words(found)
    for pattern in allow:
        out = out | found.rlike(pattern)
    return out


def _free(spans: DataFrame) -> DataFrame:
    """Candidates that overlap no base span."""
    by_row, base = Window.partitionBy("row"), F.col("kind") < ENTROPY
    up = by_row.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    down = by_row.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    taken = (F.coalesce(F.max(F.when(base, F.col("end"))).over(up) > F.col("start"), F.lit(False))
             | F.coalesce(F.min(F.when(base, F.col("start"))).over(down) < F.col("end"), F.lit(False)))
    rows = spans.where(F.col("kind") != MARKER).withColumn("taken", taken)
    return rows.where((F.col("kind") == ENTROPY) & ~F.col("taken")).drop("taken")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple = ALLOW) -> DataFrame:
    """One row per row of ``docs``: id, ``base`` and ``added`` spans.

    A span is (kind, start, end) with kind as its place in KINDS, positions in code points,
    end exclusive, sorted by start. ``base`` are the matches of the three rules, ``added``
    those windows of candidates that reach their class' threshold, from the first to the
    last. ``allow`` are patterns of candidates that are no secrets; base spans stay whatever
    it says. NULL is an empty text; an empty table gives an empty result; repeated rows are
    judged one by one; other columns are not read."""
    spans = stored(proposals(docs, id_col, text_col), "secret-spans")
    candidates = _free(spans).where(~allowed(F.col("found"), allow))
    found = secret_windows(candidates.select("row", "start", "found"))
    empty = F.lit(None).cast(_SPAN)
    base = F.struct("kind", "start", "end").cast(_SPAN)
    rows = spans.where(F.col("kind") < ENTROPY).select(
        "row", F.when(F.col("kind") == MARKER, F.struct("id")).alias("of"), F.when(F.col("kind") != MARKER, base).alias("base"), empty.alias("added"))
    added = F.struct(F.lit(ENTROPY).alias("kind"), (F.col("start") + F.col("first")).alias("start"),
                     (F.col("start") + F.col("last") + WINDOW).alias("end")).cast(_SPAN)
    none = F.lit(None).cast(rows.schema["of"].dataType)
    rows = rows.unionByName(found.select("row", none.alias("of"), empty.alias("base"), added.alias("added")))
    out = rows.groupBy("row").agg(F.first("of", ignorenulls=True).alias("of"), by_start(F.collect_list("base")).alias("base"),
                                  by_start(F.collect_list("added")).alias("added"))
    return out.select(F.col("of.id").alias(id_col), "base", "added")


def by_start(spans: Column) -> Column:
    """Spans sorted by start, then kind."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.transform(order, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts by kind, ``base_sha256`` and ``spans`` of every row of ``docs``."""
    found = find_secrets(docs)

    def number(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return found.select("doc_id", *map(number, (ASSIGN, ACCESS, HEX)), F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(by_start(F.concat("base", "added"))).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """Text with its spans (sorted by start, overlapping or not) replaced by ``[secret]``."""
    done = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda a, s: F.struct(
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring(
            text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("[secret]"))).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at")))
    return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))
