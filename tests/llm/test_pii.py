import random
import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmeter.llm import pii
from odd import ROWS, empty, odd

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def base(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS.values()) for m in re.finditer(p, text or "") if holds(pii.KINDS[k], m[0])]


def own_base(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").coalesce(1)
    rows = df.select("i", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect()
    return [[tuple(x) for x in r.s] for r in sorted(rows)]


CASES = [
    "a@b.c", "a@b", "x.y+z%1@mail-1.example.co.uk_p@q.r", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.002.3.255 1.2.3", "999999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 7", "4111111111111111", "4111  1111 1111 1111", "+1 (555) 123-4567", "+12345678 9)", "++1 23456789", "+1.23.4567890123456",
    "é𝒳 a@b.c 你 1.2.3.4", "1 2 3 4 5 6 7 8 9 0 1 2 3 4", None, "", "0" * 16, "+1 (017) 555-7713 rest 4111111111111111 a@b.cc 10.0.0.1",
]


def test_base_cases(spark):
    assert own_base(spark, CASES) == [base(t) for t in CASES]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("0123456789.@+-() ab_%\né"), max_size=60), min_size=40, max_size=80))
def test_base_equals_the_plain_patterns(spark, texts):
    assert own_base(spark, texts) == [base(t) for t in texts]


def test_long_runs_end(spark):
    texts = ["1 " * 100_000, "9" * 200_000, "a" * 300_000, "a." * 100_000 + "@", "+" + "(" * 200_000, "1." * 100_000]
    # The plain patterns take quadratic time on these, so they are asked at 2,000 characters only.
    assert [len(x) for x in own_base(spark, texts)] == [0, 0, 0, 0, 0, 25_000]
    short = [t[:2000] for t in texts]
    assert own_base(spark, short) == [base(t) for t in short]


def numbered(n):
    return " ".join(f"u{i}@mail{i}.example.com" for i in range(n))


def test_many_spans_in_one_text(spark):
    text = numbered(2000)
    assert own_base(spark, [text]) == [base(text)]


def brute(docs):
    """The bootstrap over plain dictionaries."""
    occurrences = []
    for i, t in docs:
        t, found, at = t or "", base(t), 0
        for m in re.finditer(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*", t):
            gap, at = t[at:m.start()], m.end()
            core = re.search("(?s)[A-Za-z0-9+](?:.*[A-Za-z0-9])?", m[0])
            if not core:
                continue
            start, end = m.start() + core.start(), m.start() + core.end()
            if re.match("[^A-Za-z0-9+]*", m[0]).end() != core.start():
                continue
            tail = re.findall(r"[^\x20\x09-\x0D]+", gap[-80:].lower())
            contexts = [" ".join(tail[-n:]) for n in (1, 2) if len(tail) >= n]
            inside = [b for b in found if b[1] < end and b[2] > start]
            label = next((b[0] for b in inside if b[1] >= start), -2 if inside else -1)
            occurrences.append((i, start, end, core[0], contexts, label))
    times = defaultdict(int)
    for _, _, _, token, contexts, label in occurrences:
        for p in contexts if label >= -1 else ():
            times[p, token, label] += 1
    of_pattern = defaultdict(list)
    for p, token, label in times:
        of_pattern[p].append((token, label))
    kept = {p: x for p, x in of_pattern.items() if len(x) >= pii.SUPPORT}
    unlabelled = defaultdict(lambda: [0] * 4)
    for turn in range(pii.ROUNDS):
        patterns = {}
        for p, members in kept.items():
            total, out = sum(times[p, *m] for m in members), []
            for k in range(4):
                scores = [(times[p, *m], 1_000_000 * (m[1] == k) if m[1] >= 0 else unlabelled[m[0]][k]) for m in members]
                out.append(sum(n * s for n, s in scores) // total if sum(2 * s >= 1_000_000 for _, s in scores) >= pii.SUPPORT else 0)
            patterns[p] = out
        sums = defaultdict(lambda: [0, 0, 0, 0, 0])
        for p, members in kept.items():
            for token, label in members:
                if label < 0:
                    n = times[p, token, label]
                    sums[token] = [s + n * v for s, v in zip(sums[token], [*patterns[p], 1])]
        if turn + 1 < pii.ROUNDS:
            unlabelled = defaultdict(lambda: [0] * 4, {t: [v // s[4] for v in s[:4]] for t, s in sums.items()})
    out = []
    for i, t in docs:
        extra = set()
        for j, start, end, _, contexts, label in occurrences:
            if i == j and label == -1:
                best = max(((patterns[p][k], -k) for p in contexts if p in patterns for k in range(4)), default=(0, 0))
                if best[0] >= pii.CONFIDENCE:
                    extra.add((-best[1], start, end))
        out.append((i, base(t), sorted([*base(t), *extra])))
    return out


def planted():
    rng = random.Random(4)
    docs = []
    for i in range(30):
        docs.append((i, f"text {i} with contact mail: user{i}@site{i % 5}.org and then"))
    for i in range(30, 36):
        docs.append((i, f"some words contact mail: user{i}(at)site.org, more"))
    docs += [(40 + i, f"server address 10.0.{i}.{rng.randrange(256)} up") for i in range(8)]
    docs += [(50, "server address 10.0.0.300 down"), (51, "number of 7 and of 8 and of 9 and of a@b.cc"), (52, "")]
    return docs


def tuples(spans):
    return [tuple(s) for s in spans]


def test_contexts_find_what_patterns_miss(spark):
    docs = planted()
    got = [(r.doc_id, tuples(r.base), tuples(r.spans)) for r in pii.find_pii(odd(spark, [(i, t, None) for i, t in docs])).collect()]
    assert sorted(got) == sorted(brute(docs))
    by_id = {i: s for i, _, s in got}
    assert all(len(by_id[i]) == 1 and by_id[i][0][0] == 0 for i in range(30, 36))
    assert [k for k, *_ in by_id[50]] == [1] and [k for k, *_ in by_id[51]] == [0]


def test_odd_rows(spark):
    docs = [(i, t) for i, t, _ in ROWS if i is not None]
    short = [(i, t) for i, t in docs if i not in (8, 9)]
    got = [(r.doc_id, tuples(r.base), tuples(r.spans)) for r in pii.find_pii(odd(spark, [(i, t, None) for i, t in short])).collect()]
    assert sorted(got) == sorted(brute(short))
    assert pii.find_pii(odd(spark)).count() == len(docs)
    assert pii.find_pii(empty(spark)).collect() == []


def test_redaction(spark):
    text = "é a@b.cc then 10.0.0.1 and 4111 1111 1111 1111."
    df = spark.createDataFrame([(1, text), (2, "clean"), (3, "")], "doc_id long, text string")
    out = df.withColumn("spans", pii.base_spans(F.col("text"))).select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t")).collect()
    assert {r.doc_id: r.t for r in out} == {1: "é [EMAIL] then [IP] and [CARD].", 2: "clean", 3: ""}


def test_support_counts_whole_entities_and_added_spans_cover_whole_runs(spark):
    """Phones of one country code are different instances; an unlabelled identifier is all of its words."""
    docs = [(i, f"please dial +1 ({i:03d}) 555-77{i:02d} now") for i in range(30)]
    docs += [(30, "please dial 0171 555 1234 now"), (31, "please dial (0171) 555 1235, 12 times"), (32, "then 0171 555 1234 now")]
    docs += [(40 + i, f"card given 4111 1111 1111 {n} ok") for i, n in enumerate(("1111", "1129", "1137", "1145", "1152"))]
    docs += [(50, "card given 4111 1111 1111 1112 ok")]
    got = {r.doc_id: [(*s,) for s in r.spans] for r in pii.find_pii(odd(spark, [(i, t, None) for i, t in docs])).collect()}
    texts = dict(docs)
    cut = {i: [(pii.KINDS[k], texts[i][a:b]) for k, a, b in s] for i, s in got.items()}
    assert all(cut[i] == [("phone", texts[i][12:-4])] for i in range(30))
    assert cut[30] == [("phone", "0171 555 1234")] and cut[31] == [("phone", "0171) 555 1235")] and cut[32] == []
    assert all(k == [("card", texts[i][11:-3])] for i, k in cut.items() if 40 <= i < 50)
    assert cut[50] == [("card", "4111 1111 1111 1112")]


def test_redaction_leaves_nothing_of_overlapping_spans(spark):
    texts = ["x 192.168.1.5@mail.example.com y", "x +491701234567@sms.example.com y", "0123456789abcdef a@b.cc"]
    spans = [None, None, [(3, 0, 4), (1, 2, 9), (2, 8, 10), (0, 10, 12)]]
    df = spark.createDataFrame(list(zip(texts, spans)), "text string, given " + pii._SPAN)
    out = [r.t for r in df.select(pii.redacted(F.col("text"), F.coalesce("given", pii.base_spans(F.col("text")))).alias("t")).collect()]
    assert out == ["x [EMAIL] y", "x [EMAIL] y", "[IP][EMAIL]cdef a@b.cc"]
