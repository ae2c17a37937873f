import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from silverline.llm import sentence_pieces as S

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rnd = random.Random(1)
    parts = [*"abcthe \n\t", "  ", "é", "一", "𝔘", "\x00", "    ", "ing", "the ", "😀", "\u00a0", "Ünïcode", " of the"]
    out = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    return ["", " ", "  a", "a" * 300, "the" * 300, "ab " * 100, "\n", *out]


def encode(values, dropout, seed=3, variants=16):
    with open(MODEL, "rb") as f:
        vocabulary = S.Vocabulary(f.read())
    ids, off = S.encode_slice(pa.array(values), np.arange(len(values)).astype(np.uint64), vocabulary, dropout, seed, variants)
    return [ids[a:b].tolist() for a, b in zip(off, off[1:])], vocabulary


def test_without_dropout_it_is_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert encode(texts(), 0.0)[0] == model.encode(texts())


def test_every_dropout_decodes_losslessly_and_varies():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    values = [*texts(), "▁", "a ▁▁b", "▁ ▁"]
    sizes = []
    for dropout in (0.0, 0.1, 0.5, 1.0):
        ids, vocabulary = encode(values, dropout)
        assert S.decode_slice(pa.array(ids, pa.list_(pa.int32())), vocabulary).to_pylist() == values
        assert [model.decode(x) for x in ids] == values
        sizes.append(sum(map(len, ids)))
    assert sizes == sorted(sizes) and sizes[0] < sizes[-1]
    same = encode(["segmentation varies with the document"] * 40, 0.3)[0]
    assert len({tuple(x) for x in same}) > 10
    assert encode(["segmentation varies"], 0.3, seed=1) [0] == encode(["segmentation varies"], 0.3, seed=1)[0]


def test_heap_and_matrix_agree(monkeypatch):
    want = encode(texts(), 0.3)[0]
    monkeypatch.setattr(S, "MATRIX_CHARS", 0)
    assert encode(texts(), 0.3)[0] == want


def test_agenda_against_a_plain_one():
    """Skipping by the keyed hash, one candidate at a time."""
    words = ["internationalisation", "thththththe", "ofofthe", "aaaaaaa"]
    for word in words:
        ids, vocabulary = encode([word], 0.4, variants=1)
        raw = np.array([ord(c) for c in " " + word], np.uint32)
        chars = vocabulary.char_id[raw]
        content = S.C.span_hash(raw.view(np.uint8), np.array([0]), np.array([4 * len(raw)]))
        key = S.C.mix(content + np.uint64(3 * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1))
        spans = [(k, k + 1, int(c)) for k, c in enumerate(chars)]
        skipped = set()
        while True:
            best = None
            for left, right in zip(spans, spans[1:]):
                rank, piece = vocabulary.merged(np.array([left[2]]), np.array([right[2]]))
                border = left[0], right[0], right[1], left[2], right[2]
                if rank[0] != S._NONE and border not in skipped and (best is None or rank[0] < best[0]):
                    best = int(rank[0]), border, left, right, int(piece[0])
            if best is None:
                break
            _, border, left, right, piece = best
            if S._skips(key, *[np.array([x]) for x in border[:3]], 0.4)[0]:
                skipped.add(border)
                continue
            at = spans.index(left)
            spans[at:at + 2] = [(left[0], right[1], piece)]
        assert ids[0] == [s[2] for s in spans]


def test_frames(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "a ▁ text\n", 1), (3, "a ▁ text\n", 1), (None, "word " * 50_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS int").withColumnRenamed("doc_id", "doc_id")
    coded = S.encode_pieces(df, MODEL)
    back = S.decode_pieces(coded, MODEL).collect()
    assert [r.decoded for r in back] == [t or "" for _, t, _ in rows] and back[2].ids == back[3].ids
    assert S.encode_pieces(df.limit(0), MODEL).collect() == []
    lists = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in S.decode_pieces(lists, MODEL).collect()] == [None, ""]
    moved = S.encode_pieces(df.repartition(3), MODEL).filter("doc_id = 3").first()
    assert moved.ids == back[2].ids


def test_every_occurrence_is_drawn_by_itself(monkeypatch):
    """A frequent unit has all its segmentations, and those without a skip are the undropped one."""
    word = ["internationalisation"] * 3000
    whole = encode(word[:1], 0.0)[0][0]
    found = [tuple(x) for x in encode(word, 0.3, variants=None)[0]]
    assert len(set(found)) > 100
    merges = 0
    for ids in encode(word[:1], 1.0)[0]:
        merges = len(ids) - len(whole)
    share = sum(x == tuple(whole) for x in found) / len(found)
    assert share > 0.5 * 0.7 ** merges
    # in one text, too
    ids, vocabulary = encode([" ".join(word)], 0.3, variants=None)
    text = S.decode_slice(pa.array(ids, pa.list_(pa.int32())), vocabulary)
    assert text.to_pylist() == [" ".join(word)]
    assert len(ids[0]) > 3000 * len(whole)
    for limit in (S.MATRIX_CHARS, 0):
        monkeypatch.setattr(S, "MATRIX_CHARS", limit)
        want = encode(texts(), 0.1, variants=None)[0]
        # the short way gives what segmenting every occurrence gives
        with monkeypatch.context() as m:
            m.setattr(S, "_dropped", lambda word, *_: np.ones(len(word), bool))
            assert encode(texts(), 0.1, variants=None)[0] == want


def test_frames_draw_more_than_sixteen(spark):
    df = spark.range(2000).selectExpr("id as doc_id", "'internationalisation' as text")
    assert S.encode_pieces(df, MODEL, dropout=0.3).select("ids").distinct().count() > 16
