"""The pipeline against plain Python, stage by stage on each stage's input."""

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as P
from silverline.sources.tables import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in P.STAGES:
        after = P.stored(stage(spark, docs, SF), "test-stage")
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def test_documents_columns_stay_until_the_last_stage(spark, stages):
    for before, after in stages[:-1]:
        assert after[0].__fields__ == before[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_keeps_documents_with_letters(stages):
    before, after = stages[0]
    kept = {r.doc_id for r in after}
    assert {r.doc_id for r in before if not any(map(str.isalpha, r.text or ""))}.isdisjoint(kept)
    assert len(kept) >= 0.98 * sum(any(map(str.isalpha, r.text or "")) for r in before)


def test_lines_near_copies_and_benchmark(spark, stages):
    before, after = stages[1]
    assert sorted((r.doc_id, r.text) for r in after) == sorted((i, t) for i, t, _, _ in brute.line_dedup([(r.doc_id, r.text) for r in before]))
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = stages[2]
    classes = brute.near_classes([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(i for i, (c, _, _) in classes.items() if c == i)
    before, after = stages[3]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    # every item, both ways; an item within its budget shares a word with the text
    words = {i: (set(brute.words(t)), t) for i, t in items}
    found = set()
    for r in before:
        own = set(brute.words(r.text))
        near = [(i, t) for i, (w, t) in words.items() if 10 * len(w & own) >= 7 * len(w)]
        if near and brute.leaks(r.text, near):
            found.add(r.doc_id)
    assert found and {r.doc_id for r in before} - {r.doc_id for r in after} == found


def test_pieces_decode_to_the_text(stages):
    before, after = stages[4]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in before}
    assert {r.doc_id: model.decode(r.ids) for r in after} == texts
    assert all(r.n_pieces == len(r.ids) for r in after)


def test_last_stage_decodes_every_text(stages):
    assert stages[4][1] and all(r.lossless for r in stages[4][1])


def test_run_gives_the_last_stage(spark, stages):
    assert sorted((r.doc_id, r.n_pieces) for r in P.run(spark, SF).select("doc_id", "n_pieces").collect()) == sorted((r.doc_id, r.n_pieces) for r in stages[4][1])


def odd(spark):
    """Documents with nulls, ties, repeated rows, odd ids and columns named as the operators' own."""
    known = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in table(spark, SF, "documents").orderBy("doc_id").limit(60).collect()]
    text = known[3][1]
    rows = known + [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "\n \n", "en", "s", 3), (903, "12 34", None, "s", 5),
                    known[5], known[5], (904, text, "en", None, 1), (None, text, None, None, None), (905, "word " * 60_000, "en", "s", 1)]
    extra = ("class_id", "copy_of", "n_links", "leaks", "lang_pred", "score", "n_lines", "n_dropped", "k1", "segs")
    frame = spark.createDataFrame([(*r, *[i] * len(extra)) for i, r in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in extra))
    return frame, extra


def test_odd_rows_and_clashing_columns(spark):
    docs, extra = odd(spark)
    for k, (_, stage) in enumerate(P.STAGES):
        before, after = docs.count(), P.stored(stage(spark, docs, SF), "test-odd")
        assert 0 < after.count() <= before
        if k < 4:
            assert after.columns == docs.columns
            # the other columns come through untouched
            assert after.filter(" or ".join(f"{c} <> {extra[0]} or {c} is null" for c in extra)).count() == 0
        docs = after
    assert docs.filter("not lossless").count() == 0


def test_empty_table(spark):
    docs = odd(spark)[0].limit(0)
    for _, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0
