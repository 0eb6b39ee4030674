"""op6: held-out accuracy and defined results for odd rows."""

import zlib

from rillflow.llm import langid
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import awkward_docs, docs_frame, table, with_clashes, write


def test_query_held_out(spark, scratch):
    rows = awkward_docs() + [(20_000 + r["doc_id"], r["text"][::-1] and r["text"], r["lang"], "s")
                             for r in table("documents")]
    sf = write(with_clashes(docs_frame(spark, rows)), scratch + "/d", "documents")
    got = REGISTRY["op6_language_id"](spark, sf).collect()
    assert len(got) == len(rows)
    lang = {r["doc_id"]: r["lang"] for r in table("documents")}
    held = [r for r in got if r["held_out"] and r["doc_id"] in lang]
    right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in held)
    assert len(held) > 20 and right / len(held) >= 0.95
    for r in got:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    pred = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert all(pred[i] == ("und", 0.0) for i in (9001, 9002, 9003, 9006))
    assert all(r["lang_pred"] in {"en", "de", "fr", "es", "und"} for r in got)


def test_no_or_one_language_and_unknown_ones(spark):
    docs = docs_frame(spark, [(1, "some text", None, "s"), (2, None, "en", "s")])
    model = langid.fit(docs)
    assert model.predict("some text") == ("und", 0.0)
    model = langid.fit(docs_frame(spark, [(1, "some text", "xx", "s")]))
    assert model.predict("other")[0] == "xx" and model.predict("...") == ("und", 0.0)
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(
        [("abc abd abe " * 5, "aa"), ("xyz xyw xyv " * 5, "bb"), ("qrs qrt qru " * 5, "en"),
         ("mno mnp mnq " * 5, "de"), ("ghi ghj ghk " * 5, "fr")] * 3)]
    model = langid.fit(docs_frame(spark, rows))
    assert model.families == ["aa", "bb", "germanic", "romance"] and model.pairs == [("de", "en")]
    assert [model.predict(t)[0] for t in ("abc abd", "xyz xyw", "qrs qru", "mno mnq", "ghi")] \
        == ["aa", "bb", "en", "de", "fr"]
    assert langid.identified(docs.limit(0), model, "p").collect() == []


def test_pieces_of_a_long_text_add_up(monkeypatch):
    text = "the quick brown fox éè " * 50
    whole = langid.vector(text)
    monkeypatch.setattr(langid, "_PIECE", 37)
    part = langid.vector(text)
    assert (whole[0] == part[0]).all() and abs(whole[1] - part[1]).max() < 1e-6
