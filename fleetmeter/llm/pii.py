"""Personal data by patterns, and by contexts that the patterns' own finds teach.

All of it is DataFrame code. Base entities come from four regular expressions with checks. They
are the seeds of a bootstrap: the one and two words before an identifier (a word with a digit or
an at-sign) are its lexical patterns. An instance is a whole base entity, or a whole run of adjacent
identifiers that are in none. Over the graph of patterns and instances each pattern
takes the mean score of its instances and each unlabelled instance the mean score of its patterns,
round by round. Patterns that end up confident for a kind turn the unlabelled identifiers behind
them into entities of that kind.

Scores are whole millionths, so results don't depend on the order of additions. Edges are counted
before they are joined, and patterns with too few instances to ever be confident are left out
first, which is what common words and rare pairs shrink to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import spill_to_table

from .support import filled, picked

#: Kinds in their order.
KINDS = ("email", "ip", "card", "phone")
#: Distinct instances a pattern needs, its least mean score (in millionths), and rounds of scoring.
SUPPORT, CONFIDENCE, ROUNDS = 3, 800_000, 3
_ONE = 1_000_000
#: Characters before an identifier in which its context words lie.
_CONTEXT_CHARS = 80

# The kinds' expressions, written so that no place is tried twice: possessive where what follows
# can't match what was taken, and no start inside a run that failed at its beginning (\G admits the
# place right behind the previous match).
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IP_VALID = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}(?<!\.)$"
_IDENTIFIER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value computed once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _before(steps: Column, use: Callable[[Callable[[Column], Column]], Column], block: int = 256) -> Column:
    """use(f), where f(i) is the sum of the first i steps, from sums of whole blocks."""
    count = F.ceil(F.size(steps) / block).cast("int")
    blocks = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda b: _total(F.slice(steps, b * block + 1, block))))
    return let(blocks, lambda sums: use(
        lambda i: _total(F.slice(sums, 1, F.floor(i / block).cast("int"))) + _total(F.slice(steps, F.floor(i / block).cast("int") * block + 1, i % block))))


def _matches(text: Column, pattern: str, make: Callable[[Column, Column, Column], Column]) -> Column:
    """make(gap before, match, start) for each match of a pattern, leftmost and not overlapping."""
    pieces = F.struct(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("hit"))
    return let(pieces, lambda m: let(
        F.zip_with(F.slice(m["gap"], 1, F.size(m["hit"])), m["hit"], lambda g, h: F.length(g) + F.length(h)),
        lambda steps: _before(steps, lambda before: F.transform(
            m["hit"], lambda h, i: make(F.get(m["gap"], i), h, before(i) + F.length(F.get(m["gap"], i)))))))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    def doubled(d: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return F.when(x > 9, x - 9).otherwise(x)

    return let(_digits(text), lambda d: F.when(
        F.length(d).between(13, 19), _total(F.transform(F.sequence(F.lit(0), F.length(d) - 1), lambda i: doubled(d, i))) % 10 == 0
    ).otherwise(F.lit(False)))


_SPAN = "array<struct<kind:int,start:int,end:int>>"
_NAMED = "array<struct<kind:int,start:int,end:int,token:bigint>>"


def _spans(text: Column, kind: int, pattern: str, valid: Callable[[Column], Column] | None, sign: str | None) -> Column:
    found = _matches(text, pattern, lambda _, h, start: F.struct(
        F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(h)).alias("end"), h.alias("hit")))
    if valid:
        found = F.filter(found, lambda s: valid(s["hit"]))
    found = F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.xxhash64(s["hit"]).alias("token"))).cast(_NAMED)
    return F.when(text.contains(sign), found).otherwise(F.array().cast(_NAMED)) if sign else found


def base_spans(text: Column) -> Column:
    """Base entities by kind, then start: array of (kind number, start, end) in code points, end exclusive."""
    return _plain(_named_spans(text))


def _plain(named: Column) -> Column:
    return F.transform(named, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(_SPAN)


def _named_spans(text: Column) -> Column:
    """Base entities with a hash of each one's whole text."""
    return F.concat(
        _spans(text, 0, _EMAIL, None, "@"),
        _spans(text, 1, _IP, lambda h: h.rlike(_IP_VALID), "."),
        _spans(text, 2, _CARD, lambda h: (F.length(h) >= 13) & _luhn(h), None),
        _spans(text, 3, _PHONE, lambda h: F.length(_digits(h)).between(9, 15), "+"),
    )


def _identifiers(text: Column) -> Column:
    """Words with a digit or an at-sign: (core without outer punctuation, its start and end, contexts, whether
    only white space and no stop lies between it and the word before)."""
    def make(gap: Column, word: Column, start: Column) -> Column:
        lead = F.length(F.regexp_extract(word, "^[^A-Za-z0-9+]*", 0))
        core = F.regexp_extract(word, "(?s)[A-Za-z0-9+](?:.*[A-Za-z0-9])?", 0)
        tail = F.regexp_extract_all(F.lower(F.substring(gap, -_CONTEXT_CHARS, _CONTEXT_CHARS)), F.lit(r"[^\x20\x09-\x0D]+"), 0)
        contexts = let(tail, lambda w: F.filter(F.array(
            F.when(F.size(w) > 0, F.get(w, F.size(w) - 1)),
            F.when(F.size(w) > 1, F.concat(F.get(w, F.size(w) - 2), F.lit(" "), F.get(w, F.size(w) - 1)))), lambda x: x.isNotNull()))
        return F.struct(core.alias("core"), (start + lead).alias("start"), (start + lead + F.length(core)).alias("end"), contexts.alias("contexts"),
                        (~gap.rlike(r"[^\x20\x09-\x0D]")).alias("follows"), word.rlike(r"""[.,;:!?]["')\]]?\z""").alias("stops"))

    return F.filter(_matches(text, _IDENTIFIER, make), lambda s: F.length(s["core"]) > 0)


def _labelled(identifiers: Column, base: Column) -> Column:
    """Instances: (token, a hash of its text; start, end, contexts, label). The label is the kind of the base
    entity that starts in the word, whose whole text is the token; -2 where a word only overlaps one; -1 for a
    run of adjacent words in no base entity, from the first word to the last."""
    def label(x: Column) -> Column:
        inside = F.filter(base, lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"]))
        return let(inside, lambda b: let(F.get(F.filter(b, lambda y: y["start"] >= x["start"]), F.lit(0)), lambda first: F.struct(
            x["core"].alias("core"), x["start"].alias("start"), x["end"].alias("end"), x["contexts"].alias("contexts"), x["follows"].alias("follows"),
            x["stops"].alias("stops"), first["token"].alias("token"), F.coalesce(first["kind"], F.when(F.size(b) > 0, F.lit(-2)), F.lit(-1)).alias("label"))))

    def runs(w: Column) -> Column:
        def begins(x: Column, i: Column) -> Column:
            before = F.get(w, i - 1)
            return F.when((i > 0) & x["follows"] & ~before["stops"] & (x["label"] == -1) & (before["label"] == -1), F.lit(None)).otherwise(i)

        def whole(heads: Column) -> Column:
            def run(i: Column, n: Column) -> Column:
                end = F.coalesce(F.get(heads, n + 1), F.size(w))
                text = F.array_join(F.transform(F.slice(w, i + 1, end - i), lambda x: x["core"]), " ")
                return let(F.get(w, i), lambda x: F.struct(
                    F.coalesce(x["token"], F.xxhash64(text)).alias("token"), x["start"].alias("start"), F.get(w, end - 1)["end"].alias("end"),
                    x["contexts"].alias("contexts"), x["label"].alias("label")))

            return F.transform(heads, run)

        return let(F.filter(F.transform(w, begins), lambda i: i.isNotNull()), whole)

    return let(F.transform(identifiers, label), runs)


def confident_patterns(instances: DataFrame) -> DataFrame:
    """pattern, kind and confidence from rows of pattern, token and label (a kind number, or -1)."""
    scores = [f"s{k}" for k in range(len(KINDS))]
    counted = instances.groupBy("pattern", "token", "label").agg(F.count("*").alias("times"))
    enough = counted.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT).select("pattern")
    edges = spill_to_table(counted.join(enough, "pattern"), "edges")
    scored = edges.select("*", *[F.when(F.col("label") == k, _ONE).otherwise(0).cast("long").alias(s) for k, s in enumerate(scores)])
    for turn in range(ROUNDS):
        patterns = spill_to_table(scored.groupBy("pattern").agg(*[
            F.when(F.count_if(F.col(s) * 2 >= _ONE) >= SUPPORT, F.floor(F.sum(F.col("times") * F.col(s)) / F.sum("times"))).otherwise(0).alias(s)
            for s in scores]), "patterns")
        if turn + 1 < ROUNDS:
            means = edges.where("label < 0").join(patterns, "pattern").groupBy("token").agg(
                *[F.floor(F.sum(F.col("times") * F.col(s)) / F.sum("times")).alias(s) for s in scores])
            known = edges.where("label >= 0").select("*", *[F.when(F.col("label") == k, _ONE).otherwise(0).cast("long").alias(s) for k, s in enumerate(scores)])
            scored = spill_to_table(known.unionByName(edges.where("label < 0").join(means, "token")), "scores")
    best = F.array_max(F.array(*[F.struct(F.col(s).alias("confidence"), F.lit(-k).alias("kind")) for k, s in enumerate(scores)]))
    ranked = patterns.select("pattern", best.alias("best"))
    return ranked.where(F.col("best.confidence") >= CONFIDENCE).select("pattern", (-F.col("best.kind")).alias("kind"), "best.confidence")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text), base and spans: arrays of (kind, start, end) by kind, then start.

    docs: doc_id and text, other columns are ignored. A null text counts as empty and has no spans.
    Rows without doc_id are left out. Repeated rows come out as often as they came in, with equal
    spans. An empty table gives an empty result. kind is a number: its place in KINDS. spans hold
    base and what confident contexts add; an added span never overlaps a base span.
    """
    rows = picked(docs).where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("row"), filled().alias("text"))
    based = rows.select("doc_id", "row", _named_spans(F.col("text")).alias("named"), _identifiers(F.col("text")).alias("words"))
    read = spill_to_table(based.select("doc_id", "row", _plain(F.col("named")).alias("base"), _labelled(F.col("words"), F.col("named")).alias("words")), "spans")
    word = read.select("doc_id", "row", F.explode("words").alias("w")).select("doc_id", "row", "w.*")
    word = word.withColumn("pattern", F.explode("contexts")).drop("contexts")
    confident = spill_to_table(confident_patterns(word.where("label >= -1").select("pattern", "token", "label")), "confident")
    added = word.where("label = -1").join(confident, "pattern").groupBy("doc_id", "row", "start", "end").agg(
        F.max(F.struct("confidence", (-F.col("kind")).alias("kind"))).alias("best"))
    added = added.groupBy("doc_id", "row").agg(F.collect_set(F.struct((-F.col("best.kind")).alias("kind"), "start", "end")).alias("added"))
    spans = F.array_sort(F.concat("base", F.coalesce(F.col("added").cast(_SPAN), F.array().cast(_SPAN))))
    return read.select("doc_id", "row", "base").join(added, ["doc_id", "row"], "left").select("doc_id", "row", "base", spans.alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans are cut as one, under the kind of the longest."""
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), (s["end"] - s["start"]).alias("longest"))))

    def add(kept: Column, s: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        union = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                         F.when(s["longest"] > last["longest"], s["kind"]).otherwise(last["kind"]).alias("kind"),
                         F.greatest(last["longest"], s["longest"]).alias("longest"))
        return F.when((F.size(kept) == 0) | (s["start"] >= F.coalesce(last["end"], F.lit(0))), F.concat(kept, F.array(s))).otherwise(
            F.concat(F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))), F.array(union)))

    apart = F.aggregate(by_start, F.array().cast("array<struct<start:int,end:int,kind:int,longest:int>>"), add)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def cut(x: Column) -> Column:
        def end_before(i: Column) -> Column:
            return F.when(i > 0, F.get(x, i - 1)["end"]).otherwise(F.lit(0))

        pieces = F.transform(x, lambda s, i: F.concat(F.substring(text, end_before(i) + 1, s["start"] - end_before(i)), F.get(names, s["kind"])))
        rest = F.substring(text, F.get(x, F.size(x) - 1)["end"] + 1, F.length(text))
        return F.when(F.size(x) > 0, F.concat(F.concat_ws("", pieces), rest)).otherwise(text)

    return let(apart, cut)
