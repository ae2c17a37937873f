"""Token counts of whole texts (operator 4).

Texts are cut at boundaries that no token can cross, the distinct pieces of a
slice are encoded in batches balanced by bytes, and only lengths leave the
function: a text's count is the sum over its pieces.

Safe boundaries.  A byte-level vocabulary file splits texts by its pattern
before it merges, and no match of that pattern goes from a character that is
not white space into white space; nothing in the pattern looks back.  So a
text may be cut before any ASCII white space that follows something else.  A
cut never touches an added token, as these hold no white space (checked when
the file is loaded).  Characters that might be white space beyond ASCII are
taken as such, which only leaves out cuts.  Files of other kinds are encoded
text by text.

Defined cases: a null or empty text has 0 bytes and 0 tokens.  A text without
white space is one piece, however long.  Rows are counted one by one, so ties
and repeated rows need no rule.  Input columns named as the results are replaced.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import common as C

#: The larger a slice, the fewer its distinct pieces; 8 MB keep a worker under some 300 MB.
SLICE_BYTES = 8 << 20
BATCH_BYTES = 1 << 18
#: Pieces whose count a worker remembers, and the longest that it remembers.
MEMORY, REMEMBERED_BYTES = 1 << 19, 64

_SPACES = {bytes([b]) for b in np.flatnonzero(C.IS_SPACE)}


class _Encoder:
    """Counts of texts by one vocabulary file, in a Python worker."""

    def __init__(self, name: str, content: bytes):
        self.known: dict[bytes, int] = {}
        self.cuts = False
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(content.decode())
        model.no_truncation()
        model.no_padding()
        self.encode = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.ids = lambda text: model.encode_batch_fast([text], add_special_tokens=False)[0].ids
        spec = json.loads(content)
        before = spec.get("pre_tokenizer") or {}
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                     and not spec.get("normalizer")
                     and all(not any(map(str.isspace, t["content"])) and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                             for t in spec["added_tokens"]))
        #: bytes of each token: a byte-level vocabulary writes one character a byte
        self.width = np.zeros(model.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in model.get_vocab(with_added_tokens=True).items():
            self.width[i] = len(token)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        out = np.zeros(len(pieces), np.int64)
        joined, alone = [], []
        for i, piece in enumerate(pieces):
            n = self.known.get(piece)
            if n is not None:
                out[i] = n
            elif self.cuts and piece[:1] in _SPACES and len(piece) <= BATCH_BYTES and not piece[-4:].decode("utf-8", "ignore")[-1:].isspace():
                joined.append(i)
            else:
                alone.append(i)
        for batch in _balanced(joined, pieces):
            # such pieces meet at safe boundaries, so their tokens are those of their concatenation
            ends = np.cumsum([len(pieces[i]) for i in batch])
            tokens = np.cumsum(self.width[self.ids(b"".join([pieces[i] for i in batch]).decode("utf-8", "replace"))])
            out[batch] = np.diff(np.searchsorted(tokens, ends, side="right"), prepend=0)
        for batch in _balanced(alone, pieces):
            out[batch] = self.encode([pieces[i].decode("utf-8", "replace") for i in batch])
        for i in (*joined, *alone):
            if len(pieces[i]) <= REMEMBERED_BYTES:
                if len(self.known) >= MEMORY:
                    self.known.clear()
                self.known[pieces[i]] = int(out[i])
        return out


def _balanced(which: list[int], pieces: list[bytes]) -> Iterator[list[int]]:
    """Runs of ``which`` of BATCH_BYTES at most, or one longer piece."""
    held, size = [], 0
    for i in which:
        if held and size + len(pieces[i]) > BATCH_BYTES:
            yield held
            held, size = [], 0
        held.append(i)
        size += len(pieces[i])
    if held:
        yield held


def cut_points(data: np.ndarray) -> np.ndarray:
    """Byte positions before ASCII white space that follows a character which
    is surely not white space."""
    space = C.IS_SPACE[data] | ((data >= 0x1C) & (data <= 0x1F))
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    at = at[C.IS_SPACE[data[at]]]
    before = data[at - 1]
    # the last character takes its class from its lead byte: 2-byte leads but
    # C2, and 4-byte leads, start no white space
    lead = np.where(before < 0x80, 0x21, 0)
    wide = before >= 0x80
    two = data[np.maximum(at - 2, 0)]
    four = data[np.maximum(at - 4, 0)]
    lead = np.where(wide & (two >= 0xC3) & (two <= 0xDF), 0x21, lead)
    lead = np.where(wide & (four >= 0xF0) & (two >= 0x80) & (two < 0xC0), 0x21, lead)
    return at[lead == 0x21]


def token_counts(texts: pa.Array, encoder: _Encoder) -> np.ndarray:
    """Tokens of each text of one slice."""
    data, off = C.text_buffers(texts)
    if not len(data):
        return np.zeros(len(off) - 1, np.int64)
    mark = np.zeros(len(data) + 1, bool)
    mark[off] = True
    if encoder.cuts:
        mark[cut_points(data)] = True
    bounds = np.flatnonzero(mark)
    coded = pc.dictionary_encode(C.string_array(data, bounds).cast(pa.binary() if bounds[-1] < 2**31 else pa.large_binary()))
    each = encoder.counts(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    total = np.concatenate([[0], np.cumsum(each)])
    at = np.searchsorted(bounds, off)
    return total[at[1:]] - total[at[:-1]]


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than
    ``limit`` tokens) by the library of the file ``vocabulary`` (.json or
    .model), without begin, end or added special tokens."""
    C.prepared(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        content = f.read()
    shared, name = docs.sparkSession.sparkContext.broadcast(content), os.path.basename(vocabulary)

    def compute(texts: pa.Array, key=uuid.uuid4().hex) -> list[pa.Array]:
        n = token_counts(texts, C.held(key, lambda: _Encoder(name, shared.value)))
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        return [size, pa.array(n), pa.array(n > limit)]

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    return C.add_columns(docs, text_col, compute, fields, SLICE_BYTES)


def counted(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and counts alone."""
    return count_tokens(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), vocabulary, text_col).drop(text_col)
