"""Token counts per section by offset-mapped attribution.

A document is encoded once, whole, with a byte-level BPE; the tokens' byte
lengths, summed up, are their spans in the text.  Section spans are joined to
the token spans as intervals, and a token that crosses a border is allocated by
a stated rule:

* ``start``: to the section that holds its first character (first byte);
* ``majority``: to the section that holds most of its bytes, the earlier on a tie;
* ``split``: to every section it touches, in proportion to its bytes there.

Under each rule the counts of a document's sections add up to its token count,
which encoding the sections one by one does not give.

Sections tile the text.  By default they are its lines, each with the newline
that ends it; ``fields`` instead names columns whose texts, joined by a
newline, form the document, one section per field.  The join is one sorted
search of a document's tokens in its section borders, inside Arrow batches:
documents need not meet, so nothing is shuffled.

Edge cases: a null or empty text has one empty section with 0 tokens; a null
field is empty; repeated rows give repeated results; an empty table gives no
rows; extra columns are ignored; under ``majority`` equal parts go to the
earlier section.  Very long texts are encoded whole; runs of LONG_RUN or more
white characters, on which the split pattern would exhaust its stack, are cut
out where the pattern cuts them anyway, so the tokens are the same.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textvec import chunks

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
RULES = ("start", "majority", "split")
#: Fixed value: the split pattern that byte-level BPE vocabularies of this family are used with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LONG_RUN = 100_000
# The characters of Unicode's White_Space property.
WHITE_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def encode(enc, text: str, runs: re.Pattern = WHITE_RUN) -> np.ndarray:
    """Token ids of ``text``.

    The pattern takes a run of white characters as one piece up to its last
    character, which may begin the next piece, or whole at the end of the text.
    So the text before a run, that piece, and the rest are encoded one by one.
    """
    parts, at = [], 0
    for m in runs.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        parts += [enc.encode_to_numpy(text[at:m.start()], disallowed_special=()),
                  np.array(enc._encode_single_piece(text[m.start():end]))]
        at = end
    if not parts:
        return enc.encode_to_numpy(text, disallowed_special=()) if text else np.empty(0, np.int64)
    return np.concatenate([x.astype(np.int64) for x in (*parts, enc.encode_to_numpy(text[at:], disallowed_special=()))])


@lru_cache(2)
def _encoder(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        size[i] = len(token)
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def allocate(ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens per section, crossing tokens per section they start in).

    ``ends``: byte ends of the tokens, in order; ``borders``: first byte of
    each section, rising, the first one 0.
    """
    n = len(borders)
    if len(ends) == 0:
        return np.zeros(n), np.zeros(n, np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(borders, starts, side="right") - 1
    last = np.searchsorted(borders, ends - 1, side="right") - 1
    cross = np.bincount(first[last > first], minlength=n)
    if rule == "start":
        return np.bincount(first, minlength=n).astype(float), cross
    out = np.bincount(first[last == first], minlength=n).astype(float)
    stop = np.concatenate((borders[1:], [ends[-1]]))
    for i in np.flatnonzero(last > first):      # the few tokens over a border
        parts = np.arange(first[i], last[i] + 1)
        share = np.minimum(stop[parts], ends[i]) - np.maximum(borders[parts], starts[i])
        if rule == "majority":
            out[parts[np.argmax(share)]] += 1
        else:
            out[parts] += share / share.sum()
    return out, cross


SCHEMA = ("doc_id long, section int, first_char long, last_char long, n_tokens {}, n_crossing long, doc_tokens long")


def count_tokens(docs: DataFrame, fields: list[str] | None = None, rule: str = "start",
                 vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}", id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per section: (doc_id, section, first_char, last_char, n_tokens, n_crossing, doc_tokens).

    ``first_char`` and ``last_char`` bound the section in code points (end
    exclusive); ``n_crossing`` counts tokens that start in it and end behind it.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    by_line = fields is None
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in (fields or [text_col])]
    # sizes of all fields but the last, with their newline: the borders between fields
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.concat_ws("\n", *parts).alias("text"),
                       F.array(*[F.octet_length(p) + 1 for p in parts[:-1]]).cast("array<bigint>").alias("sizes"))

    def run(batches):
        enc, size = _encoder(vocabulary)
        for b in chunks(batches, max_bytes=8 << 20):
            cols = ([], [], [], [], [], [], [])
            for doc, text, gaps in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                ids = encode(enc, text)
                ends = np.cumsum(size[ids.astype(np.int64)])
                if by_line:
                    nl = np.flatnonzero(raw == 10) + 1
                    borders = np.concatenate(([0], nl[nl < len(raw)]))
                else:
                    borders = np.concatenate(([0], np.cumsum(np.asarray(gaps, np.int64))))
                n, cross = allocate(ends, borders, rule)
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                stop = np.concatenate((borders[1:], [len(raw)]))
                k = len(borders)
                for c, v in zip(cols, (np.full(k, -1 if doc is None else doc), np.arange(k), chars[borders],
                                       chars[stop], n, cross, np.full(k, len(ids)))):
                    c.append(v)
                if doc is None:
                    cols[0][-1] = np.ma.masked_all(k, np.int64)
            arrays = []
            for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                   pa.float64() if rule == "split" else pa.int64(), pa.int64(), pa.int64())):
                arrays.append(pa.concat_arrays([_column(v, t) for v in c]) if c else pa.array([], t))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "section", "first_char", "last_char",
                                                            "n_tokens", "n_crossing", "doc_tokens"])
    return rows.mapInArrow(run, SCHEMA.format("double" if rule == "split" else "long"))


def _column(values, kind) -> pa.Array:
    if isinstance(values, np.ma.MaskedArray):
        return pa.nulls(len(values), kind)
    return pa.array(values.astype(kind.to_pandas_dtype()), kind)
