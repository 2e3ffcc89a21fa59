"""Personal data: candidate spans, boosted trees, calibrated redaction (native).

Generators with high recall propose spans that may overlap: the four base kinds
(email, ip, card, phone), numbers written like them, and credentials.  Each
candidate gets format and context features; gradient-boosted trees, trained on
the candidates of the whole corpus (counted by feature pattern, so the training
table is as small as the set of patterns), score it.  A hash fold of the patterns
is held out of the trees; the threshold is the lowest score at which the accepted
candidates of that fold reach ``precision`` (of all patterns, if the fold has no
valid one).  Spans that
pass the base rules always stay.  The trees are applied as SQL expressions.

Positions are code points, end exclusive.  Defined results: a null or empty text
has no spans; repeated rows are treated alike; a table without candidates, or
with candidates of one class only, adds no spans to the base ones; further
columns of the input pass through unchanged.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, shield, unshield

BASE_KINDS = ("email", "ip", "card", "phone")
# A match starts where a run starts or where the last match ended, and runs are
# possessive: the same leftmost matches, in time linear in the text.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![0-9A-Za-z+(])[(]?[0-9][0-9().\x20/-]{5,24}[0-9](?![0-9A-Za-z])",
    "secret": r"(?i)(?<![a-z0-9_])(?:password|passwd|secret|token|api_?key)\x20{0,3}[=:]\x20{0,3}[\"']?[!-~]{6,}+",
    "key": r"(?<![0-9A-Za-z_=\"/+-])[0-9A-Za-z_/+-]{16,}+(?![0-9A-Za-z_=\"/+-])",
}
# What a text must hold for a pattern to match at all: spares most texts the scan.
NEEDS = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
    "number": "[0-9]", "secret": "[=:]", "key": "[0-9]",
}
FEATURES = ("digits", "letters", "upper", "marks", "groups", "distinct", "at", "plus", "luhn", "small_parts", "word")
CONTEXT = 24
BLOCK = 256  # items folded at once
PIECE = 4096  # code points of a text cut at once
HELD_OUT = 4  # one pattern in so many calibrates
CONTEXT_WORDS = r"(?i)(?:mail|phone|tel|call|card|visa|account|passw|secret|token|key|user|ip|address)[^\s]{0,12}\s*[=:]?\s*[\"']?$"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _running(items: Column, state: str, start: Column, step, emit, out: str) -> Column:
    """For each item ``emit(state, item)``, where ``state`` was folded over the items
    before it by ``step``.  Appending copies an array, so items go in blocks of
    ``BLOCK``: time linear in the items for any text that fits into a row."""
    block = f"struct<state:{state},out:array<{out}>>"
    none = F.array().cast(f"array<{out}>")

    def one(before: Column, part: Column) -> Column:
        return F.aggregate(
            part, F.struct(before.cast(state).alias("state"), none.alias("out")).cast(block),
            lambda a, x: F.struct(step(a["state"], x).cast(state).alias("state"), F.array_append(a["out"], emit(a["state"], x).cast(out)).alias("out")).cast(block))

    def over(whole: Column) -> Column:
        last = F.floor((F.size(whole) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(whole, i * BLOCK + 1, F.lit(BLOCK)))
        done = F.aggregate(
            blocks, F.array().cast(f"array<{block}>"),
            lambda a, part: F.array_append(a, one(F.when(F.size(a) > 0, F.get(a, F.size(a) - 1)["state"]).otherwise(start), part)))
        return F.when(F.size(whole) > 0, F.flatten(F.transform(done, lambda b: b["out"]))).otherwise(none)

    return _let(items, over)


def _luhn(digits: Column) -> Column:
    """Luhn checksum of a digit string."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, x * 2 - 9).otherwise(x * 2))
    return (digits != "") & (F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _at_most_255(p: Column) -> Column:
    q = F.ltrim(p, F.lit("0"))
    return (F.length(q) <= 2) | ((F.length(q) == 3) & (q <= "255"))


def _valid(kind: str, s: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(s, r"\."), _at_most_255)
    n = F.length(_digits(s))
    if kind == "card":
        return n.between(13, 19) & _luhn(_digits(s))
    return n.between(9, 15)


def _matches(text: Column, kind: str) -> Column:
    """Leftmost non-overlapping matches with positions: the pieces between them
    and the matches themselves, lengths summed along."""
    span = "struct<s:int,e:int,t:string,before:string>"
    pieces, hits = F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    pairs = _let(hits, lambda found: F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, h: F.struct(p.alias("p"), h.alias("h"))))
    found = _running(
        pairs, "int", F.lit(0), lambda at, x: at + F.length(x["p"]) + F.length(x["h"]),
        lambda at, x: F.struct(
            (at + F.length(x["p"])).alias("s"), (at + F.length(x["p"]) + F.length(x["h"])).alias("e"),
            x["h"].alias("t"), F.right(x["p"], F.lit(CONTEXT)).alias("before"),
        ), span)
    if kind == "card":  # runs of few digits are no cards; leaving them out keeps the arrays short
        found = F.filter(found, lambda m: F.length(_digits(m["t"])) >= 7)
    return F.when(F.rlike(text, F.lit(NEEDS[kind])), found).otherwise(F.array().cast(f"array<{span}>"))


def _described(kind: str, m: Column) -> Column:
    """A candidate with features and weak label: 1 valid format, 0 refuted, null open."""
    s, d = m["t"], _digits(m["t"])
    letters = F.regexp_replace(s, "[^A-Za-z]", "")
    base = _valid(kind, s) if kind in BASE_KINDS else F.lit(False)
    if kind in BASE_KINDS:
        label = F.when(base, 1).otherwise(0)
    elif kind == "secret":
        label = F.lit(1)
    elif kind == "key":  # long tokens of letters only are words
        label = F.when((d == "") | (letters == ""), 0)
    else:
        label = F.when(F.length(d) < 7, 0)
    up_to = lambda c, n: F.least(c, F.lit(n)).cast("double")
    return F.struct(
        F.lit(kind).alias("kind"), m["s"].alias("s"), m["e"].alias("e"), base.alias("base"), label.cast("double").alias("label"),
        F.struct(
            up_to(F.length(d), 24).alias("digits"), up_to(F.length(letters), 24).alias("letters"),
            up_to(F.length(F.regexp_replace(letters, "[^A-Z]", "")), 8).alias("upper"),
            up_to(F.length(F.regexp_replace(s, "[0-9A-Za-z]", "")), 8).alias("marks"),
            up_to(F.size(F.split(s, "[^0-9]+")), 8).alias("groups"),
            up_to(F.size(F.array_distinct(F.split(s, ""))), 24).alias("distinct"),
            F.contains(s, F.lit("@")).cast("double").alias("at"), F.startswith(s, F.lit("+")).cast("double").alias("plus"),
            (F.length(d).between(13, 19) & _luhn(d)).cast("double").alias("luhn"),
            F.forall(F.split(s, r"\."), _at_most_255).cast("double").alias("small_parts"),
            F.rlike(F.concat(m["before"], F.regexp_extract(s, "^[A-Za-z_]+\\s*[=:]", 0)), F.lit(CONTEXT_WORDS)).cast("double").alias("word"),
        ).alias("f"),
    )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``_p_c``: the array of all proposed spans."""
    x = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumns({f"_p_{k}": _matches(x, k) for k in PATTERNS})
    parts = [F.transform(f"_p_{k}", (lambda k: lambda m: _described(k, m))(k)) for k in PATTERNS]
    return found.withColumn("_p_c", F.concat(*parts)).drop(*[f"_p_{k}" for k in PATTERNS])


def fit_trees(cands: DataFrame, trees: int = 8, depth: int = 3, precision: float = 0.98):
    """(trees as nested tuples, threshold) from the candidates of every text, or None."""
    c = cands.select(F.explode_outer("_p_c").alias("c")).where("c is not null").select("c.label", "c.f.*")
    patterns = cut(c.groupBy("label", *FEATURES).agg(F.count("*").cast("double").alias("weight")))
    known = patterns.where("label is not null").withColumn("_p_out", F.pmod(F.xxhash64(*FEATURES), F.lit(HELD_OUT)) == 0)
    fitted = known.where("not _p_out")
    if fitted.select("label").distinct().count() < 2:  # too few patterns to hold some out
        fitted = known
    if fitted.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(fitted.coalesce(1))
    gbt = GBTClassifier(maxIter=trees, maxDepth=depth, weightCol="weight", seed=7, stepSize=0.4, minInfoGain=0.0)
    model = gbt.fit(rows)
    forest = [(w, _node(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees, strict=True)]
    held = known.where("_p_out")
    scored = (known if held.where("label = 1").isEmpty() else held).withColumn("p", _margin(forest, lambda n: F.col(n)))
    # One row per score: at most the trees' combinations of leaves.
    steps = scored.groupBy("p").agg(F.sum(F.col("label") * F.col("weight")).alias("hit"), F.sum("weight").alias("all"))
    upto = Window.partitionBy(F.lit(0)).orderBy(F.col("p").desc()).rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("hit").over(upto) / F.sum("all").over(upto)
    cutoff = steps.withColumn("share", share).where(F.col("share") >= precision).agg(F.min("p")).first()[0]
    return None if cutoff is None else (forest, max(float(cutoff), 0.0))


def _node(n):
    """A tree of the fitted model as (feature, threshold, left, right) or a value."""
    if n.getClass().getSimpleName() == "LeafNode":
        return float(n.prediction())
    return FEATURES[n.split().featureIndex()], float(n.split().threshold()), _node(n.leftChild()), _node(n.rightChild())


def _margin(forest, feature) -> Column:
    def value(n):
        return F.lit(n) if isinstance(n, float) else F.when(feature(n[0]) <= n[1], value(n[2])).otherwise(value(n[3]))

    return sum((F.lit(w) * value(t) for w, t in forest), F.lit(0.0))


def spans(cands: DataFrame, model) -> DataFrame:
    """Adds ``spans``: array of (kind, start, end, base), the base spans, then
    those accepted others that overlap none of them, leftmost first (of one start the
    longest) and without overlaps."""
    base = F.transform(F.filter("_p_c", lambda c: c["base"]), lambda c: F.struct(
        c["kind"].alias("kind"), c["s"].alias("start"), c["e"].alias("end"), F.lit(True).alias("base")))
    d = cands.withColumn("_p_base", base)
    if model is None:
        return d.withColumn("spans", F.col("_p_base")).drop("_p_c", "_p_base")
    forest, cutoff = model
    named = lambda k: F.when(k == "number", F.lit("phone")).when(k == "key", F.lit("secret")).otherwise(k)
    accepted = F.filter("_p_c", lambda c: ~c["base"] & ~F.coalesce(c["label"] == 0, F.lit(False)) & (_margin(forest, lambda n: c["f"][n]) >= cutoff))
    d = d.withColumn("_p_acc", accepted)
    span = "struct<start:int,minus:int,kind:string,base:boolean>"
    sortable = lambda c, kind, base: F.struct(
        c["s"].alias("start"), (c["s"] - c["e"]).alias("minus"), kind.alias("kind"), F.lit(base).alias("base"))
    every = F.array_sort(F.concat(
        F.transform(F.filter("_p_c", lambda c: c["base"]), lambda c: sortable(c, c["kind"], True)),
        F.transform("_p_acc", lambda c: sortable(c, named(c["kind"]), False))))
    end = lambda x: x["start"] - x["minus"]

    def clear(items: Column, clash) -> Column:
        """Base spans and those others that no base span seen before clashes with."""
        flagged = _running(
            items, "int", F.lit(None), lambda seen, x: F.when(x["base"], clash(seen, x, True)).otherwise(seen),
            lambda seen, x: F.struct(x.alias("x"), (x["base"] | ~F.coalesce(clash(seen, x, False), F.lit(False))).alias("ok")),
            f"struct<x:{span},ok:boolean>")
        return F.transform(F.filter(flagged, lambda f: f["ok"]), lambda f: f["x"])

    # From the left the furthest end of a base span decides, from the right the nearest start.
    left = lambda seen, x, new: F.greatest(seen, end(x)) if new else x["start"] < seen
    right = lambda seen, x, new: F.least(seen, x["start"]) if new else end(x) > seen
    cleared = clear(F.reverse(clear(every, left)), right)
    more = F.array_sort(F.filter(cleared, lambda x: ~x["base"]))
    chosen = _running(
        more, "int", F.lit(0), lambda at, x: F.when(x["start"] >= at, end(x)).otherwise(at),
        lambda at, x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), end(x).alias("end"), (x["start"] < at).alias("base")),
        "struct<kind:string,start:int,end:int,base:boolean>")
    added = F.filter(chosen, lambda x: ~x["base"])  # so far: true where it overlaps one before
    out = F.when(F.size("_p_acc") > 0, F.concat("_p_base", added)).otherwise(F.col("_p_base"))
    return d.withColumn("spans", out).drop("_p_c", "_p_base", "_p_acc")


def redacted(found: DataFrame, text: str = "text") -> DataFrame:
    """Replaces each span (overlapping ones as one) by ``[KIND]`` of its first kind."""
    x = F.coalesce(F.col(text), F.lit(""))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    cuts = F.concat(order, F.array(F.struct(F.length(x).alias("start"), F.length(x).alias("end"), F.lit(None).cast("string").alias("kind"))))
    d = found.withColumn("_p_cuts", _running(
        cuts, "int", F.lit(0), lambda at, s: F.greatest(at, s["end"]),
        lambda at, s: F.struct(at.alias("from"), s["start"].alias("to"), s["kind"].alias("kind")), "struct<from:int,to:int,kind:string>"))
    # The text in blocks of code points, so that taking a piece never walks the whole text.
    blocks = F.regexp_extract_all(x, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))

    def piece(cut_text: Column, c: Column) -> Column:
        block = lambda at: F.floor(at / PIECE).cast("int")
        parts = F.transform(F.sequence(block(c["from"]), block(c["to"] - 1)), lambda i: F.substring(
            F.get(cut_text, i), F.greatest(c["from"] - i * PIECE, F.lit(0)) + 1,
            F.least(c["to"] - i * PIECE, F.lit(PIECE)) - F.greatest(c["from"] - i * PIECE, F.lit(0))))
        before = F.when(c["to"] > c["from"], F.array_join(parts, "")).otherwise(F.lit(""))
        name = F.when(c["kind"].isNotNull() & (c["to"] >= c["from"]), F.concat(F.lit("["), F.upper(c["kind"]), F.lit("]"))).otherwise(F.lit(""))
        return F.concat(before, name)

    done = _let(blocks, lambda t: F.array_join(F.transform("_p_cuts", lambda c: piece(t, c)), ""))
    return d.withColumn(text, F.when(F.size("spans") > 0, done).otherwise(F.col(text))).drop("_p_cuts")


def span_list(chosen: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    rank = lambda k: F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(b) for b in BASE_KINDS]), k), F.lit(0)), F.lit(99))
    order = F.array_sort(F.transform(chosen, lambda s: F.struct(
        rank(s["kind"]).alias("r"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span redacted; ``n_chars``, if there, counts the new text."""
    inner = f"_in_{text}"
    cands = candidates(shield(docs), inner)
    done = redacted(spans(cands, fit_trees(cands)), inner)
    if "n_chars" in docs.columns:
        done = done.withColumn("_in_n_chars", F.when(F.size("spans") > 0, F.length(inner).cast("long")).otherwise(F.col("_in_n_chars")))
    return unshield(done, docs.columns)
