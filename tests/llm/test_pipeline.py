import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from fleetmeter.llm import pii
from odd import ROWS, component_ids, empty, odd

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def through(spark, docs, tmp_path):
    sizes = []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, "unused")
        if name != pipeline.STAGES[-1][0]:
            assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes
        out.write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
    return docs, sizes


def kept_by_hand(rows):
    """(doc_id, text) that the first three stages keep."""
    letters = [(i, t) for i, t, *_ in rows if any(c.isalpha() for c in t or "")]
    last = {}
    for i, t in letters:
        last[t] = i if last.get(t) is None else max(last[t], i if i is not None else last[t])
    distinct = sorted({(last[t], t) for _, t in letters}, key=lambda d: (d[0] is None, d[0] or 0, d[1]))
    component = component_ids(list(enumerate(t for _, t in distinct)), pipeline.NEAR_WORDS, pipeline.NEAR_PERCENT)
    return [d for k, d in enumerate(distinct) if component[k] == k]


def tokens(docs):
    return {i: len(LIBRARY.encode(t, add_special_tokens=False).ids) + 1 for i, t in docs}


def test_stages_on_odd_rows(spark, tmp_path):
    mail = [(30 + i, f"please write to contact mail: me{i}@there.org today, number {i} of all letters {i * i}", "en") for i in range(4)]
    rows = [*ROWS, *mail]
    packed, sizes = through(spark, odd(spark, rows), tmp_path)
    kept = kept_by_hand(rows)
    assert sizes[2] == sizes[3] == len(kept)
    cleaned = [(i, t.replace(f"me{i - 30}@there.org", "[EMAIL]") if (i or 0) >= 30 else t) for i, t in kept]
    assert {r.doc_id: r.doc_tokens for r in packed.collect()} == tokens(cleaned)
    after = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "pii")).collect()}
    assert all(after[i].text == t and after[i].n_chars == len(t) for i, t in cleaned)


def test_rows_without_ids_or_labels_stay(spark, tmp_path):
    """No label at all, rows without doc_id, and one doc_id with two texts, one of them a near copy."""
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(1, base, None), (5, base + " end", None), (5, "quite another text than the others here", None), (None, base + " last", None),
            (None, "nobody knows where this came from, says me@there.org", None), (None, "nobody knows where this came from, says me@there.org", None),
            (7, "12 34 !!", None), (None, "56 !", None), (9, "some text of its own", None), (None, "some text of its own", None)]
    _, sizes = through(spark, odd(spark, rows), tmp_path)
    assert sizes[:4] == [8, 6, 4, 4]
    found = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in spark.read.parquet(str(tmp_path / "pii")).collect())
    assert found == [(False, 1, base), (False, 5, "quite another text than the others here"), (False, 9, "some text of its own"),
                     (True, 0, "nobody knows where this came from, says [EMAIL]")]
    packed = spark.read.parquet(str(tmp_path / "packing")).collect()
    assert sum(r.length for r in packed) == sum(tokens(enumerate(t for *_, t in found)).values())


def test_languages_to_keep(spark, monkeypatch):
    rows = [(i, f"the house and the garden number {'abcdefgh'[i % 8]} of them", "en") for i in range(60)]
    rows += [(100 + i, f"das haus und der garten nummer {'abcdefgh'[i % 8]} für alle", "de") for i in range(60)] + [(500, "你好世界你好", None), (501, "12", "en")]
    docs = odd(spark, rows)
    assert {r.doc_id for r in pipeline.known_language(spark, docs, "").collect()} == {i for i, *_ in rows} - {501}
    monkeypatch.setattr(pipeline, "LEAST_SCORE", 0.3)
    assert {r.doc_id for r in pipeline.known_language(spark, docs, "").collect()} == {i for i, *_ in rows} - {500, 501}
    monkeypatch.setattr(pipeline, "LANGUAGES", ["de"])
    assert {r.doc_id for r in pipeline.known_language(spark, docs, "").collect()} == set(range(100, 160))


def test_long_texts_in_no_learnt_language_go(spark):
    rows = [(i, f"the house and the garden number {'abcdefgh'[i % 8]} of them", "en") for i in range(120)]
    chinese = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(400))
    rows += [(500, chinese, None), (501, "你好世界你好", None), (502, chinese, "zh"), (None, chinese + "。", None), (503, "the house and the garden of them " * 20, None)]
    kept = {(r.doc_id, r.text) for r in pipeline.known_language(spark, odd(spark, [r for r in rows if r[0] != 502]), "").collect()}
    assert kept == {(i, t) for i, t, _ in rows if i not in (500, 502, None)}
    taught = [*rows, *((i, chinese, "zh") for i in range(600, 640))]
    assert {500, 502, 503} <= {r.doc_id for r in pipeline.known_language(spark, odd(spark, taught), "").collect()}
    few = [r for r in rows if (r[0] or 500) >= 500 or r[0] < 20]
    assert pipeline.known_language(spark, odd(spark, few), "").count() == len(few)


def test_texts_of_a_sentence_in_no_learnt_language_go(spark):
    """They used to stay whatever their score, unless they had 200 n-grams."""
    rows = [(i, f"the house and the garden number {'abcdefgh'[i % 8]} of them", "en") for i in range(120)]
    chinese = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(120))
    russian = "съешь же ещё этих мягких французских булок да выпей чаю, а потом приходи к нам в гости и расскажи обо всём по порядку"
    rows += [(500, chinese, None), (501, "你好世界你好", None), (502, russian, "ru"), (None, russian + " снова", None), (503, "the house of them", None), (504, "да", None)]
    kept = {(r.doc_id, r.text) for r in pipeline.known_language(spark, odd(spark, rows), "").collect()}
    assert kept == {(i, t) for i, t, _ in rows if i not in (500, 502, None)}
    few = [r for r in rows if (r[0] or 500) >= 500 or r[0] < 20]
    assert pipeline.known_language(spark, odd(spark, few), "").count() == len(few)


def test_no_documents(spark, tmp_path):
    assert through(spark, empty(spark), tmp_path)[1] == [0] * 5


def test_run_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    table = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    kept = dict(kept_by_hand([(r["doc_id"], r["text"], r["lang"]) for r in table]))
    # Every character of a span goes, and what overlaps goes as one, under the name of its longest span.
    found = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(list(kept.items()), "doc_id long, text string")).collect()}
    for i, spans in found.items():
        text, runs = kept[i], []
        for x in sorted(spans, key=lambda x: (x.start, x.end)):
            if runs and x.start < runs[-1][1]:
                runs[-1] = (runs[-1][0], max(runs[-1][1], x.end), [*runs[-1][2], x])
            else:
                runs.append((x.start, x.end, [x]))
        for start, end, inside in reversed(runs):
            longest = max(inside, key=lambda x: x.end - x.start)
            text = f"{text[:start]}[{pii.KINDS[longest.kind].upper()}]{text[end:]}"
        kept[i] = text
    assert {r.doc_id: r.doc_tokens for r in pipeline.run(spark, sf).collect()} == tokens(kept.items())
