"""Models, mixing, formatting, archives and extraction: round trips, held-out accuracy and the defined edge cases."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_rows import rows

import corpus_pipeline
from kerbline.llm import chat, langid, layout, mixing, quality, warc
from kerbline.llm.common import table

SF = "/root/testdata/sf0.01"


def test_languages_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    found = [r for r in langid.identify(docs).collect() if r["held_out"]]
    assert len(found) > 100 and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in found]) > 0.98
    assert sum(r["rejected"] for r in found) <= 2


def test_language_edge_cases(spark):
    texts = ["the house and the garden are here"] * 30 + ["das haus und der garten sind hier"] * 30 + [None, "", "123 $$$", "the garden"]
    docs = rows(spark, texts, lang=["en"] * 30 + ["de"] * 30 + [None] * 4)
    out = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert [out[k]["lang_pred"] for k in (60, 61, 62)] == ["und"] * 3 and out[60]["score"] == 0
    assert out[63]["lang_pred"] == "en" and out[59]["lang_pred"] == "de"
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id >= 60").count() == 1
    unlabelled = rows(spark, ["some text"], lang=[None])
    assert langid.identify(unlabelled).first()["lang_pred"] == "und"
    assert langid.identify(docs.limit(0)).count() == 0


def test_quality_on_held_out_rows(spark):
    labels = table(spark, SF, "labels")
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    scored = [r for r in quality.classify(table(spark, SF, "documents"), labels).collect() if r["held_out"] and r["doc_id"] in known]
    assert np.mean([(r["score"] >= 0.7) == bool(known[r["doc_id"]]) for r in scored]) > 0.9


def test_quality_edge_cases(spark):
    docs = rows(spark, [None, "", "x", "é" * 3000], ids=[1, None, 3, 3])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.classify(docs, none).collect()} == {0.5}
    model = quality.fit([(k % 2, bytes([65 + 10 * (k % 2)]) * quality.TRAIN_CHUNKS * quality.CHUNK) for k in range(40)])
    out = quality.score(docs, model).collect()
    assert len(out) == 4 and all(0 <= r["score"] <= 1 for r in out) and out[0]["score"] == out[1]["score"]


def test_scores_of_pieces_equal_those_of_chunks():
    rng = np.random.default_rng(1)
    model = quality.fit([(k % 2, rng.integers(60 + 20 * (k % 2), 120, quality.TRAIN_CHUNKS * quality.CHUNK).astype(np.uint8).tobytes()) for k in range(40)])
    texts = [rng.integers(32, 120, n).astype(np.uint8) for n in (0, 1, 255, 256, 257, 512, 513, 5000)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = quality.probabilities(model, np.concatenate(texts), offsets)
    for text, p in zip(texts, together):
        n = quality.chunks_of(text)
        padded = np.zeros((n + 1) * quality.HOP, np.uint8)
        padded[: len(text)] = text
        chunks = np.stack([padded[k * quality.HOP : k * quality.HOP + quality.CHUNK] for k in range(n)])
        top = np.maximum(quality.responses(model, chunks).max(axis=1) + model["shift"], 0)
        logit = top.mean(axis=0) @ model["mean"] + top.max(axis=0) @ model["most"] + model["bias"][0]
        assert p == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-5)


def test_mix_follows_the_targets(spark):
    rng = random.Random(1)
    sources = [rng.choice(["a", "b", "b", "b", "c", None]) for _ in range(300)]
    texts = [" ".join(["w"] * rng.randint(1, 50)) for _ in sources] + [None, "", "  "]
    docs = rows(spark, texts, source=[*sources, "a", "a", None])
    plan = mixing.schedule(docs).collect()
    size, target, taken = {}, {}, defaultdict(int)
    for r in plan:
        key = r["row"]["source"]
        size[key], target[key] = r["source_size"], r["target"]
        taken[key] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["size"] == len((r["row"]["text"] or "").split())
    weight = dict(zip(["a", "b", "c", None], (5, 2, 1, 5)))
    expected, budget, free = {}, 1.5 * sum(size.values()), set(size)
    while True:
        share = {s: (budget - sum(expected.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        if not over:
            break
        expected |= {s: 2.0 * size[s] for s in over}
        free -= over
    assert target == pytest.approx(expected | share)
    assert all(taken[s] == int(target[s] + 1e-9) for s in size)
    mixed = mixing.mix(docs).collect()
    finish = [r["finish"] for r in mixed]
    assert finish == sorted(finish) and sum(r["words"] for r in mixed) == sum(taken.values())
    assert all(len(r["text"].split()) == r["words"] for r in mixed)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_of_a_source_without_words(spark):
    docs = rows(spark, ["a b c d", "e f", None, "", " \t", None], source=["a", "a", "b", "b", "b", None])
    plan = {r["row"]["doc_id"]: (r["source_size"], r["target"], r["taken"]) for r in mixing.schedule(docs).collect()}
    assert plan == {0: (6, 9, plan[0][2]), 1: (6, 9, plan[1][2]), **{k: (0, 0, 0) for k in range(2, 6)}}
    assert plan[0][2] + plan[1][2] == 9
    assert sorted({r["doc_id"] for r in mixing.mix(docs).collect()}) == [0, 1]
    assert mixing.mix(docs.filter("doc_id > 1")).count() == 0


def test_conversations_round_trip(spark):
    turns = [(1, 0, "user", "a\\n<|im_end|>\n\\"), (1, 1, "assistant", "b<|<|im_start|>\\|"), (1, 1, "assistant", None), (None, None, None, None), (2, 3, "as\nsistant", "<")]
    data = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_conversations(data)
    out = {r["conv_id"]: r for r in formatted.collect()}
    assert chat.turns_of(out[1]["formatted"]) == [("user", turns[0][3]), ("assistant", ""), ("assistant", turns[1][3])]
    assert chat.turns_of(out[None]["formatted"]) == [("", "")] and chat.turns_of(out[2]["formatted"]) == [("as\nsistant", "<")]
    told = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    assert told[1]["loss_sha256"] == hashlib.sha256(turns[1][3].encode()).hexdigest() and told[2]["loss_chars"] == 0
    assert chat.format_conversations(data.limit(0)).count() == 0


def test_template_language():
    assert chat.parse("{{ 'a' + 'b' }}c{% if not 'x' == 'x' %}no{% endif %}") == [("text", "abc")]
    assert chat.fold(chat.Expression("m.text + 'a' + 'b'").whole()) == ("+", ("field", ("name", "m"), "text"), ("constant", "ab"))
    text, spans = chat.compiled("{% for m in ms %}{% generation %}{{ m.t|upper }}{% endgeneration %}-{% endfor %}")({"ms": [{"t": "ab"}, {"t": "c"}]})
    assert (text, spans) == ("AB-C-", [(0, 2), (3, 4)])
    for bad in ("{{ a.__class__() }}", "{{ a|open }}", "{% import os %}", "{% for x in y %}", "{{ 1 + }}", "{% if a %}", "{{ (a }}"):
        with pytest.raises(chat.TemplateError):
            chat.compiled(bad)


def test_archives_and_index(spark):
    urls = [f"http://www.h{k % 7}.example.com/p{k}?q=ä#f" for k in range(700)] + ["http://[bad", None, "http://h0.example.com/p0?q=ä"] + ["http://hot.example/"] * 600
    pages = [(k, u, None if k % 50 == 0 else f"<p>{k % 90}</p>") for k, u in enumerate(urls)] + [(None, "http://x.org/", "<p>1</p>")]
    data = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    index = warc.build_index(warc.write_archives(data))
    records = warc.read_records(warc.find(index, warc.keys_of(data))).collect()
    last = {}
    for i, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    assert sorted((r["page_id"] is None, r["page_id"], r["url"], r["refers_to"], r["payload_digest"], r["payload_bytes"]) for r in records if r["page_id"] is not None) == sorted(
        (False, i, u, None if last[h or ""] == i else last[h or ""], warc.base32_sha1((h or "").encode()), len(h or "")) for i, u, h in pages if i is not None
    )
    assert [r["record_type"] for r in records if r["page_id"] is None] == ["revisit"]
    wanted = spark.createDataFrame([("example,hot)/",), ("nowhere)/",)], "key string")
    assert warc.find(index, wanted).count() == 600
    assert warc.find(warc.build_index(warc.write_archives(data.limit(0))), wanted).count() == 0


def test_layout(spark):
    page = (
        "<!DOCTYPE html><title>no</title><style>p{}</style><p>A <b>b</b>\n c<p>d&amp;e<ul><li>x<li>y<ul><li>z</ul></ul><ol start=3><li>q<li>r</ol>"
        "<table><tr><th>Name<th>N<tr><td>alpha beta<td>12<tr><td colspan=2>wide</table><div hidden>no</div><span style='display: none'>no</span>"
        "<pre>  a\n   b</pre>e<br>f<script>x='<p>no'</script></i></body>"
    )
    assert layout.rendered(page) == (
        "A b c\n\nd&e\n\n- x\n- y\n  - z\n\n3. q\n4. r\n\nName        N\nalpha beta  12\nwide\n\n  a\n   b\n\ne\nf"
    )
    assert layout.rendered("<div>" * 5000 + "deep") == "deep"
    assert layout.rendered("a < b <") == "a < b <"
    data = spark.createDataFrame([(1, None), (None, ""), (1, page)], "page_id bigint, html string")
    out = layout.extract(data).collect()
    assert sorted(r["n_lines"] for r in out) == [0, 0, 20] and layout.extract(data.limit(0)).count() == 0


def test_stray_text_of_tables_is_kept():
    assert layout.rendered("a<table>Note<tr><td>x<td>y</table>b") == "aNote\n\nx  y\n\nb"
    assert layout.rendered("<table><tr>Total <td>5</td> more<tbody>rest</tbody></table>") == "Total morerest\n\n5"
    assert layout.rendered("<table><tr><td><table><tr>in<td>1</table><td>2</table>") == "in 1  2"
    assert layout.rendered("<table><table>t<tr><td>1</table></table>").startswith("t")
    assert layout.rendered("<div hidden><table>no<tr><td>x</table></div><table> \n<tr> <td>y</table>") == "y"


def test_deep_pages_are_exact():
    inner = "<div hidden>no</div><div style='display:none'>no</div><table><tr><td>a<td>b<tr><td>c<td>d</table><b>x</b>y<ul><li>p<li>q</ul>"
    flat = layout.rendered(inner)
    assert flat == "a  b\nc  d\n\nxy\n\n- p\n- q"
    for tag in ("i", "div", "b"):
        assert layout.rendered(f"<{tag}>" * 300 + inner) == layout.rendered(f"<{tag}>" * 100_000 + inner) == flat
    assert layout.rendered("<div hidden>" + "<b>" * 5000 + "no" + "</b>" * 5000 + "</div>yes") == "yes"
    assert layout.rendered("<table><tr><td>" * 1500 + "x<td>y") == "x y"


def test_pipeline_keeps_columns_and_clean_documents(spark):
    docs = table(spark, SF.replace("0.01", "0.001"), "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF.replace("0.01", "0.001"))
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}, name
    assert 0.75 * before < docs.count() <= before
