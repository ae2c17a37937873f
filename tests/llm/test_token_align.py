"""Alignment against a plain version over the libraries' own tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from silverline.llm import token_align
from silverline.llm.token_align import align, byte_level, gallop

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def brute(docs):
    """[(id, text)] -> rows by walking all token pairs."""
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    m = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = byte_level()
    made = []
    for i, text in docs:
        ids_a, ids_b = ([], [])
        if text:
            ids_a, ids_b = t.encode(" " + text, add_special_tokens=False).ids, m.encode(text)
        bytes_a = [bytes(byte[c] for c in t.id_to_token(x)) for x in ids_a]
        bytes_b = [bytes([int(m.id_to_piece(x)[3:5], 16)]) if m.is_byte(x) else m.id_to_piece(x).replace("▁", " ").encode() for x in ids_b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            made.append((i, [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([*map(len, bytes_a)]).tolist(), np.cumsum([*map(len, bytes_b)]).tolist()
        groups, links = [], []
        x = y = 0
        for e in sorted(set(ends_a) & set(ends_b)):
            u, v = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append((ids_a[x:u], ids_b[y:v]))
            x, y = u, v
        for k, (s, e) in enumerate(zip([0, *ends_a], ends_a)):
            for n, (p, q) in enumerate(zip([0, *ends_b], ends_b)):
                if p < e and s < q:
                    links.append((ids_a[k], ids_b[n]))
        made.append((i, ids_a, ids_b, groups, links))
    count = Counter(p for *_, links in made for p in set(links))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    for i, ids_a, ids_b, groups, links in made:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (i, len(ids_a), len(ids_b), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
               hashlib.sha256(text.encode()).hexdigest() if text else "")


TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b\t c", "word", "don't we'll   see <|endoftext|> and <s> or </s> or <0x41>",
    "naïve café 東京都 の 天気 🙂🙂  ok", "x" * 3000, "▁ already marked", "has ▁ inside", "tab\tend\n", "end space ", " nbsp  em 　wide",
    "1234567890 3.14159 https://example.org/a?b=c#d", "ab" * 50 + " " + "ba" * 41, "\x00null \x1cfs\x1c gs", "Привет мир, как дела? ", "é combining",
    "word", "the the the the", "....!!!???", "\r\n\r\n", "a\u0085b \u0085 c",
]


def checked(spark, docs, monkeypatch=None):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in align(frame, A, B, digest=True).collect()), key=str)


@pytest.mark.parametrize("limit", [1, 200, 1 << 22])
def test_odd_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(token_align, "SLICE_BYTES", limit)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(4, "a repeated id"), (None, "no id")]
    assert checked(spark, docs) == sorted(brute(docs), key=str)


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 2500").collect()]
    assert len(docs) > 50
    assert checked(spark, docs) == sorted(brute(docs), key=str)


def test_gallop_finds_every_lower_bound():
    rng = np.random.default_rng(5)
    ends = np.unique(rng.integers(1, 4000, 700))
    wanted = np.concatenate([ends, rng.integers(1, ends[-1], 300)])
    first, last = np.zeros(len(wanted), int), np.full(len(wanted), len(ends))
    for guess in (0, len(ends) - 1, len(ends) // 2):
        assert (gallop(ends, first, last, np.full(len(wanted), guess), wanted) == np.searchsorted(ends, wanted)).all()


def test_groups_text_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align(empty, A, B).count() == 0
    odd = spark.createDataFrame([("k", "a word", 3, 4)], "doc_id string, text string, slice int, n_a int")
    row = align(odd, A, B).collect()[0]
    assert row.doc_id == "k" and row.groups.count(";") == row.n_groups - 1 and row.groups.split("|")[0].isdigit()


def test_slices_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(token_align, "PART_BYTES", 50)
    monkeypatch.setattr(token_align, "SLICE_BYTES", 300)
    docs = [*enumerate(TEXTS)] * 2
    assert checked(spark, docs) == sorted(brute(docs), key=str)


def test_stored_slices_lie_in_small_row_groups(spark, monkeypatch):
    real, kept = token_align.stored, {}

    def stored(df, what, **options):
        kept[what] = real(df, what, **options)
        return kept[what]

    monkeypatch.setattr(token_align, "stored", stored)
    monkeypatch.setattr(token_align, "PART_BYTES", 1 << 14, raising=False)
    monkeypatch.setattr(token_align, "GROUP_ROWS", 8, raising=False)
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice([*"aeiourstlnmd"], 5)) for _ in range(4000)]
    docs = [(i, " ".join(rng.choice(words, 700))) for i in range(1500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    found = align(frame, A, B, digest=True).collect()
    groups = []
    for path in kept["align-slices"].inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:").replace("///", "/")).metadata
        groups += [meta.row_group(k).total_byte_size for k in range(meta.num_row_groups)]
    assert sum(groups) > 1 << 20 and max(groups) < 1 << 19
    monkeypatch.setattr(token_align, "SLICE_BYTES", 1 << 18)
    assert sorted(found) == sorted(align(frame, A, B, digest=True).collect())


def test_blocks_of_a_slice(monkeypatch):
    texts = pa.array([*TEXTS, *TEXTS])
    with open(A, "rb") as a, open(B, "rb") as b:
        a, b = token_align._Side(A, a.read()), token_align._Side(B, b.read())
    decimals = token_align._decimals(max(a.size, b.size))
    whole = token_align.align_slice(texts, a, b, decimals, False)
    monkeypatch.setattr(token_align, "TEXT_TOKENS", 3)
    monkeypatch.setattr(token_align, "PAIR_LINKS", 5)
    made = token_align.align_slice(texts, a, b, decimals, False)
    assert made["groups"] == whole["groups"] and made["groups"][10].count(";") == whole["n_groups"][10] - 1
    assert (made["held"] == whole["held"]).all() and made["held"].max() > 2
    assert [*token_align.blocks(np.array([0, 0, 3, 3, 9, 10, 10]), 4)] == [(0, 4), (4, 6)]
    assert [*token_align.blocks(np.array([0]), 4)] == [] and [*token_align.blocks(np.array([0, 0, 0]), 4)] == [(0, 2)]
