"""Fill-in-the-middle transformation, cut through a sparse index of multibyte characters.

A document is cut in two places into prefix, middle and suffix and written as
``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle) between
three marks.  Cuts fall between units: lines (``[^\\n]*\\n|[^\\n]+``) or code
points.

Texts are UTF-8 bytes, and cuts are needed both as bytes (to slice) and as code
points (to report, or because units are code points).  ``CharIndex`` records
only the exceptions: for every multibyte character its place and the bytes it
takes beyond one.  One ``searchsorted`` counts the exceptions before a cut;
everything between them is ASCII, where code points and bytes advance alike, so
the rest is a subtraction.  An ASCII text has an empty index.

Draws come from the id alone: the first four 8-digit groups of
sha256("seed:id") are the two cuts, the form draw and the order draw, so every
document is decided without the others, and nothing is shuffled.

``restore`` rebuilds the text from output and form.  No mark has a border (a
proper prefix that is also its suffix) and no cut document contains a mark, so
the first occurrence of a mark is the written one.

Edge cases: a null text is empty; an empty text, or one that contains a mark,
stays ``plain`` with null lengths; a null id draws as the empty string; repeated
rows and ties (both cuts equal: empty middle) are ordinary; very long texts are
cut whole, in a chunk of their own; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textvec import chunks, flat

MARKS = ("<P>", "<S>", "<M>")
UNITS = ("line", "char")
SEED = 7
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class CharIndex:
    """Multibyte characters of ``data``: their byte places, code-point places and excess bytes."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate(([0], np.cumsum(excess)))     # excess bytes of the first k exceptions
        self.char = self.byte - self.before[:-1]

    def to_char(self, byte: np.ndarray) -> np.ndarray:
        """Code points before each byte cut (cuts lie between characters)."""
        return byte - self.before[np.searchsorted(self.byte, byte)]

    def to_byte(self, char: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return char + self.before[np.searchsorted(self.char, char)]


def cut_lines(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines per text, byte cuts of ``draws`` modulo lines + 1); cuts are places in ``data``."""
    start, stop = offsets[:-1], offsets[1:]
    newline = np.flatnonzero(data == 10) + 1
    first, last = np.searchsorted(newline, start, side="right"), np.searchsorted(newline, stop, side="right")
    behind = np.where(last > first, newline[np.maximum(last, 1) - 1] if len(newline) else 0, start)
    n = last - first + (behind < stop)
    k = draws % (n + 1)
    at = newline[np.clip(first + k - 1, 0, len(newline) - 1)] if len(newline) else np.zeros_like(k)
    return n, np.where(k == 0, start, np.where(k == n, stop, at))


def cut_chars(index: CharIndex, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points per text, byte cuts of ``draws`` modulo code points + 1)."""
    edge = index.to_char(offsets)
    n = np.diff(edge)
    return n, index.to_byte(edge[:-1] + draws % (n + 1))


def _join(data, offsets, low, high, plain, spm, marks) -> list[bytes]:
    p, s, m = (x.encode() for x in marks)
    raw, out = data.tobytes(), []
    for a, b, i, j, keep, swap in zip(offsets[:-1].tolist(), offsets[1:].tolist(), low.tolist(), high.tolist(),
                                      plain.tolist(), spm.tolist()):
        if keep:
            out.append(raw[a:b])
        elif swap:
            out.append(b"".join((s, raw[j:b], p, raw[a:i], m, raw[i:j])))
        else:
            out.append(b"".join((p, raw[a:i], s, raw[j:b], m, raw[i:j])))
    return out


def transform(docs: DataFrame, unit: str = "line", fim_percent: int = 100, spm_percent: int = 50, seed: int = SEED,
              marks: tuple[str, str, str] = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n, form, prefix_chars, middle_chars, output); ``n`` counts its units."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    if any(k and x.startswith(x[-k:]) for x in marks for k in range(1, len(x))) or not all(marks) or len(set(marks)) < 3:
        raise ValueError("marks must be distinct, not empty and free of borders")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), *draw)

    def run(batches):
        for b in chunks(batches):
            data, offsets = flat(b.column("text"))
            h = [b.column(f"h{i}").to_numpy() for i in range(1, 5)]
            index = CharIndex(data)
            n, one = cut_lines(data, offsets, h[0]) if unit == "line" else cut_chars(index, offsets, h[0])
            _, two = cut_lines(data, offsets, h[1]) if unit == "line" else cut_chars(index, offsets, h[1])
            low, high = np.minimum(one, two), np.maximum(one, two)
            plain = (np.diff(offsets) == 0) | (h[2] % 100 >= fim_percent)
            for x in marks:
                plain |= pc.match_substring(b.column("text"), x).to_numpy(zero_copy_only=False)
            spm = h[3] % 100 < spm_percent
            edge, i, j = index.to_char(offsets[:-1]), index.to_char(low), index.to_char(high)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()),
                 pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")), pa.string()),
                 pa.array(i - edge, pa.int64(), mask=plain), pa.array(j - i, pa.int64(), mask=plain),
                 pa.array(_join(data, offsets, low, high, plain, spm, marks), pa.binary()).view(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return rows.mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text behind ``output``: its parts lie between the first occurrences of the marks."""
    p, s, m = marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, F.lit(len(first) + 1), F.char_length(output))
        one = F.substring_index(rest, second, 1)
        rest = F.substring(rest, F.char_length(one) + len(second) + 1, F.char_length(output))
        two = F.substring_index(rest, m, 1)
        return one, two, F.substring(rest, F.char_length(two) + len(m) + 1, F.char_length(output))
    prefix, suffix, middle = parts(p, s)
    suffix2, prefix2, middle2 = parts(s, p)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(output))


def oracle(seed: int = SEED, fim_percent: int = 100, spm_percent: int = 50) -> str:
    """DuckDB: lines joined again from the split text, cut by code points."""
    h = ", ".join(f"('0x' || substr(hx, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))
    first = "CASE WHEN {0} = 0 THEN '' WHEN {0} = n THEN t ELSE array_to_string(l[1:{0}], chr(10)) || chr(10) END"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS hx
        FROM documents),
    h AS (SELECT *, {h}, (length(t) - length(replace(t, chr(10), ''))
        + CASE WHEN t = '' OR right(t, 1) = chr(10) THEN 0 ELSE 1 END)::BIGINT AS n, string_split(t, chr(10)) AS l FROM d),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS c1, greatest(h1 % (n + 1), h2 % (n + 1)) AS c2,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {fim_percent}
        THEN 'plain' WHEN h4 % 100 < {spm_percent} THEN 'spm' ELSE 'psm' END AS form FROM h),
    e AS (SELECT *, {first.format("c1")} AS p, {first.format("c2")} AS pm FROM c),
    f AS (SELECT *, substr(t, length(p) + 1, length(pm) - length(p)) AS m, substr(t, length(pm) + 1) AS s FROM e)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM f"""
