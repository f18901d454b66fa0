"""Personal data by candidate gradient boosting (operator 6).

Generators with high recall propose spans: the four base patterns, and looser ones
for digit groups and spelt-out addresses. Spans that pass a base rule stay. Boosted
trees (Spark ML) score each loose proposal by features of its format and its context;
it is added when its score reaches the threshold and it overlaps no base span.

A proposal must be possible as its kind at all (octets, Luhn, number of digits); that is a
rule, and neither a label nor a feature. The trees tell likely ones from look-alikes that
are as possible: positive examples are base spans (and a few fixed ones) rewritten as the
base patterns cannot match them, without '+', with other separators or spelt out, in
contexts of their kind or none; negative ones are dates, ranges, serial and order numbers
and plain prose made from the same spans, and the same numbers in other contexts. Proposals
of the corpus itself have no label and train nothing. The threshold is the least one that
reaches a wanted precision on sources and formats that the trees have not seen.

One scan proposes spans for all texts; positions are running sums of the lengths of
matches and of the gaps between them. DataFrame and SQL functions and Spark ML only.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: The base patterns, written so that Java's matcher neither backtracks over long runs nor
#: recurses: a run is entered at its start (or where the last match ended), and a chain of
#: groups is one lazy run that stops where the chain must.
BASE = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@(?=[{_DOMAIN}]++\.[{_DOMAIN}])[{_DOMAIN}.]+?(?=\.(?![{_DOMAIN}])|[^{_DOMAIN}.]|\z)",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])(?<![0-9][ -])[0-9](?=[ -]?[0-9])[0-9 -]*?(?=[ -](?![0-9])|[^0-9 -]|\z)",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
#: Looser generators: digit groups with any usual separators, and addresses spelt out.
DIGITS, SPELT = 4, 5
LOOSE = {
    DIGITS: r"(?<![0-9])[+(]?[0-9][0-9 ().\[\]/-]{5,38}[0-9](?![0-9])",
    SPELT: (r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+(?: ?[(\[]at[)\]] ?(?:[a-z0-9-]{1,63}+ ?(?:[(\[]dot[)\]]|\.) ?){1,8}"
            r"| at (?:[a-z0-9-]{1,63}+ dot ){1,8})[a-z]{2,10}(?![a-z])"),
}
LEFT, RIGHT = 24, 8          # characters of context
MARKER = -1                  # row that keeps a text without proposals
SOURCES = 300                # base spans of a kind that are rewritten, at most
TREES, DEPTH = 12, 4
PRECISION = 0.95
FORMS = 8                    # spellings of one projection
CALIBRATION_FOLD = 4         # one source, and one format, in so many calibrates
OCTETS = r"^(?:0*[0-9]{1,2}|0*1[0-9]{2}|0*2[0-4][0-9]|0*25[0-5])(?:\.(?:0*[0-9]{1,2}|0*1[0-9]{2}|0*2[0-4][0-9]|0*25[0-5])){3}$"
CONTEXT = {"email": "mail|contact|write", "ip": r"\bip\b|host|server|addr", "card": "card|visa|credit|pay", "phone": "phone|tel|call|fax|mobile"}
OTHER = "isbn|order|invoice|serial|version|build|part|item|ticket|batch|\\bref\\b|\\bid\\b|\\bno\\b|\\bsku\\b|date|born|since|between"
FEATURES = ["k_email", "k_ip", "k_card", "k_phone", "length", "digits", "separators", "groups", "first_group", "last_group", "plus",
            "paren", "dots", "left_word", "right_word", "left_space", "right_space", "digit_share", "context", "other", "dated", "suffix"]
DATED = (r"^[(\[]?(?:(?:1[0-9]|20)[0-9]{2}([-/. ])[01]?[0-9]\1[0-3]?[0-9]|[0-3]?[0-9]([-/. ])[0-3]?[0-9]\2(?:1[0-9]|20)?[0-9]{2})(?![0-9])"
         r"|^[(\[]?(?:1[0-9]|20)[0-9]{2} ?[-/] ?(?:1[0-9]|20)[0-9]{2}(?![0-9])")
SUFFIX = (r"(?i)[^a-z](?:com|org|net|edu|gov|mil|int|info|biz|io|ai|app|dev|co|eu|uk|us|ca|au|nz|de|at|ch|fr|es|it|nl|be|se|no|dk|fi|pl|cz|pt|ie"
          r"|ru|ua|cn|jp|kr|in|br|mx|ar|za|tr|gr|hu|ro|example|test)$")
#: Base spans of every kind, rewritten as well: no kind is without examples, whatever the corpus.
SEEDS = [(k, found) for i in range(12) for k, found in (
    (0, f"{('jane.doe', 'info', 'max_m', 'a.b')[i % 4]}{i or ''}@{('example', 'mail.example', 'my-site')[i % 3]}.{('org', 'com', 'de', 'net')[i % 4]}"),
    (1, f"{10 + 19 * i}.{(7 * i) % 256}.{(31 * i + 5) % 256}.{(77 * i + 1) % 256}"),
    (2, ("4111111111111111", "5500005555555559", "6011000990139424", "4012888888881881")[i % 4]),
    (3, (f"+1 ({201 + 37 * i}) 555-{1000 + 411 * i}", f"+44 20 7946 {1000 + 311 * i}", f"+49 30 {2345670 + 977 * i}")[i % 3]))]


def _matches(text: Column, pattern: str, kind: int, trigger: str | None) -> Column:
    """Array of (kind, gap, found, left, right) of a pattern's matches in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(found.alias("m"), gaps.alias("g"), F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0))).alias("h"))
    rows = F.transform(F.filter(zipped, lambda z: z["m"].isNotNull()), lambda z, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(z["g"]).alias("gap"), z["m"].alias("found"),
        F.right(z["g"], F.lit(LEFT)).alias("left"), F.left(F.coalesce(z["h"], F.lit("")), F.lit(RIGHT)).alias("right")))
    empty = F.lit(None).cast("array<struct<kind:int,i:int,gap:int,found:string,left:string,right:string>>")
    return F.when(F.contains(F.lower(text), F.lit(trigger)), rows).otherwise(empty) if trigger else rows


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + _luhn_digit(digits, i))
    return total % 10 == 0


def _luhn_digit(digits: Column, i) -> Column:
    d = F.ascii(F.substring(F.reverse(digits), i, F.lit(1))) - 48
    twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    return F.when(i % 2 == 0, twice).otherwise(d).cast("int")


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All proposed spans (``row, id, kind, start, end, found, left, right, base``) and one
    marker row for every text; ``base`` tells the kind's base rule."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    triggers = ("@", ".", None, "+")
    parts = [_matches(F.col("text"), p, k, t) for k, (p, t) in enumerate(zip(BASE, triggers))]
    parts += [_matches(F.col("text"), p, k, None if k == DIGITS else "at") for k, p in LOOSE.items()]
    marker = F.array(F.struct(F.lit(MARKER).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit("").alias("found"),
                              F.lit("").alias("left"), F.lit("").alias("right")))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,found:string,left:string,right:string>>")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select("id", "row", F.explode(F.concat(marker, *[F.coalesce(p, none) for p in parts])).alias("p")).select("id", "row", "p.*")
    rows = stored(rows, "pii-matches")
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("found")).over(before)
    rows = rows.repartition("row").withColumn("end", end).withColumn("start", F.col("end") - F.length("found"))
    digits = F.regexp_replace("found", "[^0-9]", "")
    n = F.length(digits)
    base = (F.when(F.col("kind") == 0, F.lit(True))
            .when(F.col("kind") == 1, F.col("found").rlike(OCTETS))
            .when(F.col("kind") == 2, F.when(n.between(16, 19), luhn(digits)).otherwise(F.lit(False)))
            .when(F.col("kind") == 3, n.between(8, 15)).otherwise(F.lit(False)))
    return rows.select("row", "id", "kind", "start", "end", "found", "left", "right", base.alias("base"))


def rewritten(sources: DataFrame) -> DataFrame:
    """Loose spellings of base spans and look-alikes of them (``kind, found, left, right``) as
    examples: their spans, ``as_kind``, ``form`` (number of the spelling) and ``label``; only
    those that a loose generator proposes and that are possible as their kind."""
    found, digits = F.col("found"), F.regexp_replace("found", "[^0-9]", "")
    groups = F.regexp_extract_all("found", F.lit("[0-9]+"), F.lit(0))
    fours = lambda d, by: F.regexp_replace(d, "([0-9]{4})(?=[0-9])", f"$1{by}")
    local, domain = F.substring_index("found", "@", 1), F.substring_index("found", "@", -1)
    n, h = F.size(groups), F.pmod(F.xxhash64("found"), F.lit(1 << 30))
    year, month, day = F.lit(1950) + h % 90, F.lpad((h % 12 + 1).cast("string"), 2, "0"), F.lpad((h % 28 + 1).cast("string"), 2, "0")
    both = F.concat(digits, h.cast("string"), digits)

    def pick(words: tuple) -> Column:
        """One of some contexts, by the source."""
        return F.get(F.array(*[F.lit(w) for w in words]), (h % len(words)).cast("int"))

    own = {"email": ("mail: ", "write to ", "contact ", "reach us, "), "ip": ("server ", "host ", "ip ", "from "),
           "card": ("card ", "visa: ", "pay with ", "credit card no. "), "phone": ("phone: ", "call ", "tel. ", "mobile ")}
    others = ("order ", "invoice no ", "serial ", "isbn ", "ticket ", "part no. ", "ref ", "item ")

    def ex(text: Column, good: bool = True, left: Column | None = None, right: str = " ") -> Column:
        return F.struct(text.alias("found"), F.lit(good).alias("good"), (F.lit(" ") if left is None else left).alias("left"), F.lit(right).alias("right"))

    def spoken(kind: str, texts: list[Column]) -> list[Column]:
        """Good in its own context and in none, no good in another one."""
        return [e for t in texts for e in (ex(t, True, pick(own[kind])), ex(t), ex(t, False, pick(others)))]

    emails = [e for at, dot in ((" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), ("(at)", "."), (" at ", " dot "), (" AT ", " DOT "))
              for t in (F.concat(local, F.lit(at), F.replace(domain, F.lit("."), F.lit(dot))),) for e in (ex(t), ex(t, True, pick(own["email"])))]
    emails += [ex(F.concat(local, F.lit(" at "), F.substring_index(domain, ".", 1), F.lit(f" dot {w}")), False) for w in ("matrix", "line", "and", "product")]
    ips = spoken("ip", [F.replace(found, F.lit("."), F.lit(by)) for by in ("[.]", "(.)", " . ", ". ")])
    ips += [ex(F.concat(found, F.lit("."), h % 30), False), ex(F.concat_ws(".", h % 9, month, day, h % 40), False, F.lit("version "))]
    cards = spoken("card", [fours(digits, by) for by in (".", "/", " - ", "  ")])
    cards += [ex(fours(digits, "."), False, F.lit("7e"), "c4"), ex(digits, False, F.lit("7e"), "c4")]
    phones = spoken("phone", [
        *[F.array_join(groups, by) for by in ("-", ".", " ", "/")],
        F.concat(F.lit("("), groups[0], F.lit(") "), F.array_join(F.slice(groups, F.lit(2), n), "-")),
        F.when(n > 3, F.concat(F.lit("("), groups[1], F.lit(") "), F.array_join(F.slice(groups, F.lit(3), n), "-"))),
        F.when(n > 3, F.array_join(F.slice(groups, F.lit(2), n), "-")), F.when(n > 3, F.array_join(F.slice(groups, F.lit(2), n), ".")),
        F.when(n > 3, F.array_join(F.slice(groups, F.lit(2), n), " ")), F.concat(F.lit("0"), F.array_join(F.slice(groups, F.lit(2), n), "/"))])
    phones += [ex(F.ltrim(F.substring(found, 2, 64)), True, pick(own["phone"])), ex(digits, True, pick(own["phone"])),
               *[ex(digits, False, F.lit(a), b) for a, b in ((" ", " "), ("7e", " "), (" ", "c4"), ("7e", "c4"))], ex(digits, False, pick(others)),
               *[ex(F.substring(both, 3, m), False, F.lit(a), b) for m in (8, 10, 12, 14, 15) for a, b in ((" ", " "), ("7e", "c4"))],
               *[ex(F.substring(both, 5, m), False, pick(others)) for m in (8, 10, 13)],
               ex(F.concat_ws("-", F.lit("978"), h % 9, F.substring(both, 2, 2), F.substring(both, 4, 6), h % 10), False, F.lit("isbn ")),
               ex(F.concat_ws("-", F.lit("978"), h % 9, F.substring(both, 2, 2), F.substring(both, 4, 6), h % 10), False),
               *[ex(F.concat_ws(by, year, month, day), False, left) for by in ("-", "/", ".") for left in (None, F.lit("date "))],
               ex(F.concat_ws(".", day, month, year), False), ex(F.concat_ws("/", month, day, year), False), ex(F.concat_ws(" ", year, month, day), False),
               ex(F.concat(F.lit(""), year, F.lit("-"), year + 3), False), ex(F.concat(F.lit(""), year, F.lit(" - "), year + 7), False, F.lit("between ")),
               ex(F.concat_ws(".", h % 9, h % 40, h % 7, h % 100, h % 31), False), ex(F.concat_ws(".", h % 9, month, (h % 100000).cast("string")), False)]
    rows = None
    for k, one in enumerate((emails, ips, cards, phones)):
        for j in range(0, len(one), FORMS):  # a few at a time, so that each is compiled
            part = sources.where(F.col("kind") == k).select(
                F.col("kind").alias("of"), F.xxhash64("found").alias("source"), F.posexplode(F.array(*one[j:j + FORMS])).alias("form", "f"))
            part = part.withColumn("form", F.col("form") + j)
            rows = part if rows is None else rows.unionByName(part)
    rows = rows.select("of", "source", "form", "f.*", F.when(F.col("of") == 0, SPELT).otherwise(DIGITS).alias("kind"))
    rows = rows.where(F.when(F.col("kind") == SPELT, F.col("found").rlike(f"^(?:{LOOSE[SPELT]})$")).otherwise(F.col("found").rlike(f"^(?:{LOOSE[DIGITS]})$")))
    rows = featured(as_kinds(rows)).where("possible")
    return rows.withColumn("label", (F.col("good") & (F.col("of") == F.col("as_kind"))).cast("double"))


def as_kinds(spans: DataFrame) -> DataFrame:
    """Loose proposals, once for every kind that they may be (``as_kind``)."""
    kinds = F.when(F.col("kind") == DIGITS, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(0)))
    return spans.where(F.col("kind") >= DIGITS).withColumn("as_kind", F.explode(kinds))


def untaken(spans: DataFrame) -> DataFrame:
    """Loose proposals that overlap no span of a base rule."""
    by_row = Window.partitionBy("row")
    up = by_row.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    down = by_row.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    taken = (F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(up) > F.col("start"), F.lit(False))
             | F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(down) < F.col("end"), F.lit(False)))
    rows = spans.where(F.col("base") | (F.col("kind") >= DIGITS)).withColumn("taken", taken)
    return rows.where((F.col("kind") >= DIGITS) & ~F.col("taken")).drop("taken")


def featured(rows: DataFrame) -> DataFrame:
    """Loose proposals of one kind each, with the features of FEATURES as columns, and
    whether they are ``possible`` as that kind."""
    count = lambda pattern: F.length("found") - F.length(F.regexp_replace("found", pattern, ""))
    last, first = F.right("left", F.lit(1)), F.left("right", F.lit(1))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    context = F.lit(False)
    for k, name in enumerate(KINDS):
        context = F.when(F.col("as_kind") == k, F.lower("left").rlike(CONTEXT[name])).otherwise(context)
    digits = F.regexp_replace("found", "[^0-9]", "")
    n, dated, paren = F.length(digits), F.col("found").rlike(DATED), F.col("found").rlike(r"[(\[]")
    possible = (F.when(F.col("as_kind") == 0, F.lit(True))
                .when(F.col("as_kind") == 1, F.regexp_replace("found", r"[\[\]() ]", "").rlike(OCTETS))
                .when(F.col("as_kind") == 2, F.when(n.between(16, 19), luhn(digits)).otherwise(F.lit(False)))
                .otherwise(n.between(8, 15)))
    word = r"^[A-Za-z0-9_=\"']$"
    return rows.withColumns({
        **{f"k_{name}": flag(F.col("as_kind") == k) for k, name in enumerate(KINDS)},
        "length": F.length("found").cast("double"), "digits": count("[0-9]").cast("double"),
        "separators": count(r"[ ()./\[\]-]").cast("double"), "groups": F.size(F.regexp_extract_all("found", F.lit("[0-9]+"), F.lit(0))).cast("double"),
        "first_group": F.length(F.regexp_extract("found", "[0-9]+", 0)).cast("double"),
        "last_group": F.length(F.regexp_extract("found", "[0-9]*$", 0)).cast("double"),
        "plus": flag(F.startswith(F.col("found"), F.lit("+"))), "paren": flag(paren), "dots": count("[.]").cast("double"),
        "left_word": flag(last.rlike(word)), "right_word": flag(first.rlike(word)),
        "left_space": flag(last.rlike(r"^\s?$")), "right_space": flag(first.rlike(r"^\s?$")),
        "digit_share": count("[0-9]") / F.greatest(F.length("found"), F.lit(1)), "context": flag(context),
        "other": flag(F.lower("left").rlike(OTHER)), "dated": flag(dated), "suffix": flag(F.col("found").rlike(SUFFIX)),
        "possible": F.coalesce(possible, F.lit(False))})


def scored(spans: DataFrame) -> tuple[DataFrame, float]:
    """Loose proposals that overlap no base span with their probability, and the
    calibrated threshold.

    Examples are ``rewritten`` spans of at most SOURCES base spans a kind, chosen by hash.
    Calibration takes the sources of one fold and, of all sources, the spellings of one in
    CALIBRATION_FOLD numbers: the trees have seen neither."""
    rows = stored(featured(as_kinds(untaken(spans))).where("possible"), "pii-loose")
    order, part = F.xxhash64("found", "left", "right"), spans.select("kind", "found", "left", "right")
    sources = spans.sparkSession.createDataFrame([(k, f, " ", " ") for k, f in SEEDS], part.schema)
    for k in range(len(KINDS)):
        sources = sources.unionByName(part.where(spans["base"] & (F.col("kind") == k)).orderBy(order, "found", "left").limit(SOURCES))
    sources = stored(sources.dropDuplicates(["kind", "found"]), "pii-sources")
    made = stored(rewritten(sources).select("source", "form", "label", *FEATURES), "pii-rewritten")
    unseen = (F.pmod(F.xxhash64("source", F.lit(1)), F.lit(CALIBRATION_FOLD)) == 0) | (F.pmod(F.xxhash64("form", F.lit(3)), F.lit(CALIBRATION_FOLD)) == 0)
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11, stepSize=0.3).fit(
        stored(vector.transform(made.where(~unseen)).select("features", "label"), "pii-train"))
    probability = vector_to_array("probability")[1]

    def judged(df: DataFrame) -> DataFrame:
        return model.transform(vector.transform(df)).withColumn("p", probability)

    bins = (judged(made.where(unseen)).groupBy(F.floor(F.col("p") * 100).cast("int").alias("bin"))
            .agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("bin")).collect())
    threshold, good, n = 1.01, 0.0, 0
    for b in bins:  # at most 101 rows
        good, n = good + b.good, n + b.n
        if good < PRECISION * n:
            break
        threshold = b.bin / 100
    return judged(rows), max(threshold, 0.5)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``base`` and ``added`` spans.

    A span is (kind, start, end) with kind as its place in KINDS, positions in code
    points, end exclusive, sorted. NULL is an empty text; an empty table gives an
    empty result; repeated rows are judged one by one; other columns are not read."""
    spans = stored(proposals(docs, id_col, text_col), "pii-proposals")
    span = F.struct(F.col("kind").alias("kind"), "start", "end")
    rows = spans.select("row", "id", F.when(F.col("base"), span).alias("base"), F.lit(None).cast("struct<kind:int,start:long,end:long>").alias("added"))
    judged, threshold = scored(spans)
    more = judged.where(F.col("p") >= threshold).groupBy("row", "id", "kind", "start", "end").agg(F.max_by("as_kind", "p").alias("as_kind")).select(
        "row", "id", F.lit(None).cast("struct<kind:int,start:long,end:long>").alias("base"),
        F.struct(F.col("as_kind").alias("kind"), "start", "end").alias("added"))
    rows = rows.unionByName(more)
    out = rows.groupBy("row", "id").agg(F.array_sort(F.collect_list("base")).alias("base"),
                                        F.array_sort(F.collect_set("added")).alias("added"))
    return out.select(F.col("id").alias(id_col), "base", "added")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts by kind, ``base_sha256`` and ``spans`` of every row of ``docs``."""
    found = find_pii(docs)
    def number(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.array_sort(F.concat("base", "added"))).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """Text with its spans (of any order, overlapping or not) replaced by ``[kind]``."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(by_start, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda a, s: F.struct(
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(
            a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.get(names, s["kind"]))).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at")))
    return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))
