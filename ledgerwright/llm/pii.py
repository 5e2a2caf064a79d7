"""Personal data: spans that rules are sure of, and further ones chosen among proposals by boosted trees. DataFrame operations only."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, release

#: In the order of the contract; a kind's number is its place.
KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Leftmost matches that don't overlap. Possessive runs, and starts only where a run does (or where the last match ended),
#: give the same matches as the plain patterns in time linear in the text.
SURE = (
    rf"((?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++)",
    r"((?<![0-9])[0-9]++(?:\.[0-9]++){3})",
    r"([0-9](?:[\x20-]?[0-9])++)",
    r"(\+[0-9][\x20().0-9-]+[0-9])",
)
#: Proposals of high recall, which may overlap: written-out addresses, guarded dots, other separators, national numbers.
PROPOSED = (
    rf"((?i)(?<!{LOCAL}){LOCAL}++(?: ?@ ?| ?[\[(]at[\])] ?| at ){LABEL}++(?:(?:\.| ?[\[(]dot[\])] ?| dot ){LABEL}++)++)",
    r"((?<![0-9])[0-9]{1,3}(?: ?[\[(]?\.[\])]? ?[0-9]{1,3}){3}(?![0-9]))",
    r"((?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){11,18}(?![0-9]))",
    r"((?<![0-9])(?:\+|00)?\(?[0-9](?:[ ()./-]{0,3}[0-9]){5,14}(?![0-9]))",
)
#: What a text must hold for a pattern of either list to be looked for.
NEEDS = ("@", "[0-9]", "[0-9]", "[0-9]"), (r"(?i)@|[\[(]at[\])]| at ", "[0-9]", "[0-9]", "[0-9]")
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Words that announce a kind.
ANNOUNCE = (r"(?i)mail|contact|write", r"(?i)\bip\b|address|host|server", r"(?i)card|visa|credit|konto|carte|tarjeta", r"(?i)phone|tel|call|fax|mobil|m[oó]vil")
CONTEXT = 24
FEATURES = (
    "kind", "digits", "letters", "length", "separators", "kinds of separator", "Luhn", "octets", "prefix", "last label", "at", "dot",
    "character before", "character after", "announced", "others in the text", "first digit", "telling local part",
)
TREES, DEPTH, RATE, RIDGE = 12, 3, 0.5, 1.0
#: A kind's threshold is the lowest score that at most this share of its held-out negative examples, and so many positive ones, reach.
MISTAKES, LEAST_HELD_OUT = 0.001, 20


def digits_of(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits, at most 19, passes Luhn's test."""
    padded = F.lpad(F.when(F.length(digits).between(1, 19), digits).otherwise(F.lit("1")), 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    one = lambda k: F.substring(F.when(k % 2 == 1, doubled).otherwise(padded), k, F.lit(1)).try_cast("int")
    total = F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), lambda sum_, k: sum_ + one(k))
    return total % 10 == 0


def is_sure(kind: Column, span: Column) -> Column:
    n = F.length(digits_of(span))
    return (
        F.when(kind == 0, True)
        .when(kind == 1, span.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(kind == 2, n.between(14, 19) & luhn(digits_of(span)))
        .otherwise(n.between(10, 15))
    )


def hits(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as (row, doc_id, hits): every match of every pattern with the length of the gap before it. Durable.

    A match's place isn't asked for, which would read the text again for each; it follows from the
    gaps and matches before it.
    """
    names = []
    wide = docs.withColumn("row", F.monotonically_increasing_id())
    for sure, patterns, needs in ((1, SURE, NEEDS[0]), (0, PROPOSED, NEEDS[1])):
        for kind, (pattern, need) in enumerate(zip(patterns, needs, strict=True)):
            name = f"{'sure' if sure else 'proposed'}_{kind}"
            may = F.col("text").rlike(need)
            wide = wide.withColumn(f"{name}_match", F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(1))))
            names.append((name, sure, kind, pattern))
    gaps = [F.when(F.size(f"{name}_match") > 0, F.split("text", pattern, -1)).alias(f"{name}_gap") for name, _, _, pattern in names]
    wide = wide.select("row", "doc_id", *[f"{name}_match" for name, *_ in names], *gaps)

    def listed(name: str, sure: int, kind: int) -> Column:
        return F.coalesce(F.transform(f"{name}_match", lambda span, i: F.struct(
            F.lit(sure).alias("sure"), F.lit(kind).alias("kind"), i.alias("i"), F.length(F.get(f"{name}_gap", i)).alias("gap"), span.alias("span"),
            F.right(F.get(f"{name}_gap", i), F.lit(CONTEXT)).alias("before"), F.left(F.get(f"{name}_gap", i + 1), F.lit(CONTEXT)).alias("after"),
        )), F.array())

    return durable(wide.select("row", "doc_id", F.concat(*[listed(name, sure, kind) for name, sure, kind, _ in names]).alias("hits")))


def placed(found: DataFrame) -> DataFrame:
    """Sure spans, and proposals that overlap none, as (row, held_out, sure, kind, start, end, span, before, after, others). Durable.

    A text's matches meet in one task; they are as long as the text at most.
    """
    each = found.where(F.size("hits") > 0).select("row", held_out(F.col("doc_id")).alias("held_out"), F.explode("hits").alias("h")).select("row", "held_out", "h.*")
    upto = Window.partitionBy("row", "sure", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = each.withColumn("end", F.sum(F.col("gap") + F.length("span")).over(upto)).withColumn("start", F.col("end") - F.length("span"))
    spans = spans.where((F.col("sure") == 0) | is_sure(F.col("kind"), F.col("span")))
    in_text = Window.partitionBy("row")
    upwards, downwards = in_text.orderBy("start", F.desc("sure"), "end", "kind"), in_text.orderBy(F.desc("start"), "sure", F.desc("end"), F.desc("kind"))
    end, start = F.when(F.col("sure") == 1, F.col("end")), F.when(F.col("sure") == 1, F.col("start"))
    marked = spans.select(
        "*",
        F.max(end).over(upwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("covered"),
        F.min(start).over(downwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("next"),
        (F.sum("sure").over(in_text) - F.col("sure")).alias("others"),
    )
    free = ~F.coalesce(F.col("covered") > F.col("start"), F.lit(False)) & ~F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    return durable(marked.where((F.col("sure") == 1) | free).select("row", "held_out", "sure", "kind", "start", "end", "span", "before", "after", "others"))


def held_out(doc_id: Column) -> Column:
    """A fourth of the documents, on which thresholds are calibrated."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def features() -> Column:
    """The features of (kind, span, before, after, others), small whole numbers, as one array in the order of FEATURES."""
    kind, span, before, after = (F.col(c) for c in ("kind", "span", "before", "after"))
    digits = digits_of(span)
    octets = span.rlike(rf"^{OCTET}(?:[^0-9]+{OCTET}){{3}}$")
    marks = F.regexp_extract_all(span, F.lit("([^A-Za-z0-9]+)"), F.lit(1))

    def beside(c: Column) -> Column:
        return F.when(c.rlike(r"^\s?$"), 0).when(c.rlike(r"^[A-Za-zÀ-ÿ]$"), 1).when(c.rlike("^[0-9]$"), 2).when(c.rlike("^[=:\"'/_#]$"), 3).otherwise(4)

    announced = F.when(kind == 0, before.rlike(ANNOUNCE[0]))
    for k in (1, 2, 3):
        announced = announced.when(kind == k, before.rlike(ANNOUNCE[k]))
    small = lambda c, most: F.least(c, F.lit(most)).cast("int")
    values = [
        kind, small(F.length(digits), 20), small(F.length(F.regexp_replace(span, "[^A-Za-z]", "")), 20), small(F.floor(F.length(span) / 3), 15), small(F.size(marks), 10),
        small(F.size(F.array_distinct(marks)), 5), luhn(digits) & F.length(digits).between(12, 19), octets,
        F.when(span.startswith("+"), 1).when(span.startswith("00"), 2).when(span.startswith("("), 3).otherwise(0),
        small(F.length(F.regexp_extract(span, "[^A-Za-z]([a-z]+)$", 1)), 8),
        F.when(span.contains("@"), 1).when(span.rlike(r"(?i)[\[(]at[\])]"), 2).when(span.rlike("(?i) at "), 3).otherwise(0),
        F.when(span.rlike(r"(?i)[\[(](?:dot|\.)[\])]"), 2).when(span.rlike("(?i) (?:dot|\\.) "), 3).when(span.contains("."), 1).otherwise(0),
        beside(F.right(before, F.lit(1))), beside(F.left(after, F.lit(1))), announced, small("others", 3),
        F.when(F.length(digits) > 0, F.substring(digits, 1, 1).try_cast("int")).otherwise(-1), span.rlike(r"^[^@\[( ]*[0-9._+-][^@\[( ]*(?:@| |\[|\()"),
    ]
    return F.array(*[F.coalesce(v.cast("int"), F.lit(0)) for v in values])


def examples(spans: DataFrame) -> DataFrame:
    """(held_out, features, label, n), distinct: how often each combination of features is personal data or not. Durable.

    Nobody has labelled the spans, so sure ones serve: as they are and written in the ways that
    proposals look for they are positive, spoiled (a wrong check digit, parts too large, other counts of digits,
    a sentence for a domain) negative. Proposals as they stand in the texts count as negative too: few of
    them are personal data, and a kind's threshold can only get stricter by those that are. One that would be
    sure if it stood alone, but runs into its neighbour, is no example.
    """
    span, d = F.col("span"), digits_of(F.col("span"))
    local, domain = F.substring_index(span, "@", 1), F.substring_index(span, "@", -1)
    dots = lambda c, by: F.replace(c, F.lit("."), F.lit(by))
    fours = lambda c, by: F.regexp_replace(c, "([0-9]{4})(?=[0-9])", f"$1{by}")
    wrong = F.concat(F.substring(d, F.lit(1), F.length(d) - 1), F.pmod(F.right(d, F.lit(1)).try_cast("int") + 1, F.lit(10)).cast("string"))
    area, middle, last = F.left(F.right(d, F.lit(10)), F.lit(3)), F.left(F.right(d, F.lit(7)), F.lit(3)), F.right(d, F.lit(4))
    rest = F.regexp_replace(span, r"^[0-9]+", "")
    disguised = (
        F.array(span, *[F.concat(local, F.lit(at), dots(domain, dot)) for at, dot in ((" at ", " dot "), ("[at]", "."), ("(at)", "(dot)"), (" (at) ", " (dot) "), (" @ ", "."), (" at ", "."), (" [at] ", " [dot] "))]),
        F.array(span, *[dots(span, dot) for dot in ("[.]", "(.)", " . ", ". ")]),
        F.array(span, *[fours(d, by) for by in (".", "/", "_", "  ", " - ")]),
        F.array(span, F.concat(F.lit("00"), F.left(d, F.lit(1)), F.lit(" "), area, F.lit(" "), middle, F.lit(" "), last), F.concat(F.lit("("), area, F.lit(") "), middle, F.lit("-"), last), F.concat(area, F.lit("-"), middle, F.lit("-"), last), F.concat(area, F.lit("."), middle, F.lit("."), last),
                F.concat(F.lit("+"), F.left(d, F.lit(1)), F.lit("/"), area, F.lit("/"), middle, F.lit("/"), last)),
    )
    spoiled = (
        F.array(F.concat(F.regexp_replace(local, "[^A-Za-z]", ""), F.lit(" at "), F.regexp_extract(domain, "^[A-Za-z]*", 0), F.lit("."), F.initcap(F.regexp_extract(domain, "[A-Za-z]+$", 0)))),
        F.array(*[F.concat(F.lit(part), dots(rest, dot)) for part in ("999", "300") for dot in (".", "[.]", " . ")]),
        F.array(wrong, *[fours(wrong, by) for by in (".", "/", "_", "  ", " - ", " ")]),
        F.array(F.right(d, F.lit(10)), F.concat(middle, F.lit("-"), last), F.concat(F.left(d, F.lit(4)), F.lit("-"), F.substring(d, 5, 2), F.lit("-"), F.substring(d, 7, 2)), F.concat(d, F.lit("-"), last), F.concat(area, F.lit("."), middle)),
    )
    by_kind = lambda each: F.element_at(F.array(*each), F.col("kind") + 1)
    sure = spans.where("sure = 1")
    made = [sure.withColumn("span", F.explode(by_kind(each))).withColumn("label", F.lit(label)) for each, label in ((disguised, 1), (spoiled, 0))]
    alone = F.lit(False)
    for kind, pattern in enumerate(SURE):
        alone = F.when(F.col("kind") == kind, span.rlike(f"^{pattern}$")).otherwise(alone)
    natural = spans.where("sure = 0").where(~(alone & is_sure(F.col("kind"), span))).withColumn("label", F.lit(0))
    every = made[0].unionByName(made[1]).unionByName(natural)
    return durable(every.select("held_out", "label", features().alias("features")).groupBy("held_out", "label", "features").agg(F.count("*").alias("n")))


@dataclass(frozen=True)
class Node:
    """A leaf with its value, or a split: features[feature] <= at goes left."""

    value: float = 0.0
    feature: int = -1
    at: int = 0
    left: Node | None = None
    right: Node | None = None


@dataclass
class Model:
    trees: list[Node] = field(default_factory=list)
    base: float = 0.0
    #: By kind; a kind without one gets no further spans.
    thresholds: dict[int, float] = field(default_factory=dict)


def goes_left(feature: int, at: int) -> Column:
    return F.get("features", F.lit(feature)) <= at


def tree_value(node: Node) -> Column:
    if node.left is None:
        return F.lit(node.value)
    return F.when(goes_left(node.feature, node.at), tree_value(node.left)).otherwise(tree_value(node.right))


def margin(model: Model) -> Column:
    """The log odds of (features, ...)."""
    return F.round(sum((tree_value(t) for t in model.trees), F.lit(model.base)), 6)


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    at: int
    left: float
    right: float


def leaf(g: float, h: float) -> float:
    return round(-RATE * g / (h + RIDGE), 6)


def best_split(rows: list[tuple[int, int, float, float]]) -> Split | None:
    """The split of largest gain, with the values of its sides, from (feature, value, sum of gradients, sum of curvatures)."""
    best = None
    for f in sorted({r[0] for r in rows}):
        bins = sorted(r[1:] for r in rows if r[0] == f)
        g, h = sum(b[1] for b in bins), sum(b[2] for b in bins)
        left_g = left_h = 0.0
        for value, bin_g, bin_h in bins[:-1]:
            left_g, left_h = left_g + bin_g, left_h + bin_h
            gain = left_g**2 / (left_h + RIDGE) + (g - left_g) ** 2 / (h - left_h + RIDGE) - g**2 / (h + RIDGE)
            if gain > (best.gain if best else 0) + 1e-6:
                best = Split(gain, f, value, leaf(left_g, left_h), leaf(g - left_g, h - left_h))
    return best


def grow(data: DataFrame, model: Model) -> Node:
    """One more tree, a level at a time. A level is one job, of which a row for each node, feature and value comes back: some hundreds."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    graded = data.withColumn("margin", margin(model)).withColumn("g", (p - F.col("label")) * F.col("n")).withColumn("h", p * (1 - p) * F.col("n"))
    splits: dict[int, Split] = {}  # node k has the children 2k and 2k + 1
    node = F.lit(1)
    for depth in range(DEPTH):
        at = graded.withColumn("node", node).where("node IS NOT NULL")
        sums = at.select("node", "g", "h", F.posexplode("features").alias("feature", "value")).groupBy("node", "feature", "value").agg(F.round(F.sum("g"), 6).alias("g"), F.round(F.sum("h"), 6).alias("h"))
        rows: dict[int, list] = {}
        for r in sums.collect():
            rows.setdefault(r["node"], []).append((r["feature"], r["value"], r["g"], r["h"]))
        new = {k: split for k in sorted(rows) if (split := best_split(rows[k]))}
        splits |= new
        went = F.lit(None).cast("int")
        for k, split in new.items():
            went = F.when(node == k, F.when(goes_left(split.feature, split.at), 2 * k).otherwise(2 * k + 1)).otherwise(went)
        node = went

    def made(k: int, value: float) -> Node:
        if k not in splits:
            return Node(value)
        split = splits[k]
        return Node(0.0, split.feature, split.at, made(2 * k, split.left), made(2 * k + 1, split.right))

    return made(1, 0.0)


def train(spans: DataFrame) -> Model:
    """Boosted trees of the log loss, and a threshold for each kind from the held-out documents.

    All spans take part. The trees are fitted on distinct combinations of features with their
    counts; what reaches the driver is sums by node, feature and value, and counts by kind and score.
    Without examples of both labels there is no model, and nothing is added to the sure spans.
    """
    data = examples(spans)
    fit = durable(data.where("NOT held_out").repartition(1))
    model = Model()
    n = {r["label"]: r["n"] for r in fit.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if len(n) == 2:
        model.base = round(math.log(n[1] / n[0]), 6)
        for _ in range(TREES):
            model.trees.append(grow(fit, model))
        by_score = data.where("held_out").groupBy(F.get("features", F.lit(0)).alias("kind"), F.round(margin(model), 3).alias("score"), "label").agg(F.sum("n").alias("n"))
        model.thresholds = thresholds([tuple(r) for r in by_score.collect()])
    release(data, fit)
    return model


def thresholds(counts: list[tuple[int, float, int, int]]) -> dict[int, float]:
    """The lowest score of each kind that no more than MISTAKES of its negative examples reach, of (kind, score, label, n)."""
    out = {}
    for kind in {c[0] for c in counts}:
        mine = [c for c in counts if c[0] == kind]
        negative = sum(n for _, _, label, n in mine if not label)
        reached = [0, 0]
        for score in sorted({c[1] for c in mine}, reverse=True):
            for _, at, label, n in mine:
                if at == score:
                    reached[label] += n
            if reached[0] > MISTAKES * negative:
                break
            if reached[1] >= LEAST_HELD_OUT:
                out[kind] = score
    return out


def chosen(spans: DataFrame, model: Model) -> DataFrame:
    """The proposals whose score reaches their kind's threshold; of those that overlap in a row the best one (ties: the first kind)."""
    least = F.lit(None).cast("double")
    for kind, threshold in model.thresholds.items():
        least = F.when(F.col("kind") == kind, F.lit(threshold)).otherwise(least)
    scored = spans.where("sure = 0").withColumn("features", features()).withColumn("score", F.round(margin(model), 3)).where(F.col("score") >= least)
    by_start = Window.partitionBy("row").orderBy("start", "end", "kind")
    covered = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    cluster = F.sum(F.when(F.col("covered") > F.col("start"), 0).otherwise(1)).over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    clustered = scored.withColumn("covered", covered).withColumn("cluster", cluster)
    best = F.row_number().over(Window.partitionBy("row", "cluster").orderBy(F.desc("score"), "kind", "start"))
    return clustered.withColumn("best", best).where("best = 1").select("row", "sure", "kind", "start", "end")


def find(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of each row of docs: its spans (start, kind, sure, end), by start, then kind.

    Places count code points, the end is exclusive. Sure spans are all there; proposals join them by the
    model, which is trained on these documents where none is given.

    Null and empty texts have no spans; texts of any length are read whole, in time linear in their
    length; equal rows stand each for itself; an empty table gives an empty result. Null ids
    are one id as to the held-out fold. Other columns, of any name, are not looked at.
    """
    found = hits(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")))
    spans = placed(found)
    model = train(spans) if model is None else model
    every = spans.where("sure = 1").select("row", "sure", "kind", "start", "end").unionByName(chosen(spans, model))
    listed = durable(every.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", (F.col("sure") == 1).alias("sure"), "end"))).alias("spans")))
    release(spans)
    empty = F.array().cast("array<struct<start:bigint,kind:int,sure:boolean,end:bigint>>")
    return found.select("row", "doc_id").join(listed, "row", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """text with each span of find() replaced by its kind in brackets; where spans overlap, by the kind of the first of them.

    The spans are gone through in order; each cuts its piece out of the text, so a text with very many takes
    the product of their number and its length.
    """
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    name = lambda kind: F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), kind + 1)
    piece = lambda a, s: F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
    step = lambda a, s: F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(piece(a, s), name(s["kind"]))).alias("out"))).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")))
    return F.aggregate(spans, state, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
