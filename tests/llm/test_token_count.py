import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from silverline.llm.token_count import count_tokens

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rnd = random.Random(1)
    parts = ["a", "b1", " ", ".", "\n", "\t", "'", "<|endoftext|>", "\u00a0", "\u3000", "é", "一", "😀", "\x1c", "\x85", "'s", "'ll", "  ", "\r\n", "\u200b", " word", "\n\n"]
    out = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(600)]
    return [None, "", " ", "\n", "x" * 30_000, "many words and more " * 20_000, *out, *out[:20]]


@pytest.mark.parametrize("file", [JSON, MODEL])
def test_counts_are_the_library_s(spark, file):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, file).collect()}
    if file == JSON:
        model = Tokenizer.from_file(file)
        want = [len(e) for e in model.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    else:
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        want = [len(e) for e in model.encode([t or "" for _, t in rows], num_threads=1)]
    assert got == {i: (len((t or "").encode()), n, n > 1024) for (i, t), n in zip(rows, want)}


def test_empty_table_and_clashing_columns(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), JSON).collect() == []
    row = count_tokens(spark.createDataFrame([("a b", 9, "x")], "text string, N_TOKENS int, other string"), JSON, limit=1).first()
    assert row.asDict() == {"text": "a b", "other": "x", "n_bytes": 3, "n_tokens": 2, "over_limit": True}
