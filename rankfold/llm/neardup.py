"""Near-duplicates by min-max hashing, confirmed on full shingle sets.

Words are runs outside ``\\x20 \\x09-\\x0D`` of the text with A-Z lower-cased;
a document's set holds its distinct k-word shingles (fewer words: the whole
sequence as one).  Documents are linked when 100 * common >= percent * union.

1. One pass computes, per document, the set's size, a 128-bit hash of the set
   and a min-max signature: ``PERMUTATIONS`` hash functions, of each both the
   smallest and the largest value, i.e. 128 signature values for 64 hash
   evaluations per shingle.  A band holds two minima and two maxima of four
   different functions, so its four values are independent.
2. Equal sets become one class, represented by its smallest id; from here on
   only classes count, so a third of all rows being copies costs one class.
3. Classes that share a band value are joined to one member of the bucket, the
   one that shares most band values over all its buckets (a star, not all
   pairs), and the star's links are confirmed on full sets.
4. A link between two members x, y of which one, x, is not linked to their root
   r would be missed.  Write D(x) for the symmetric difference of x and r.  From
   |x ^ y| = |D(x)| + |D(y)| - 2 |D(x) & D(y)| and x being too far from r it
   follows that x and y must share more than (1 - q) / 2 of D(y)'s elements,
   q = (100 - percent) / (100 + percent).  So in every star that still holds
   several components, members are joined on the elements of their differences
   alone, by prefix filtering (additions to the root first, then omissions), and
   the pairs found are confirmed on full sets.  What the star has in common is
   never compared, so a family of copies near its root makes no pairs at all.
   Members far from the root whose differences have elements in common (one form
   filled in or redacted in many ways) do meet: two members become a pair to
   confirm if they share an element of their prefixes and pass the size and
   position bounds, and in such a family most pairs can.
5. Components are connected again over all confirmed links.

A pair at similarity 0.8 shares no band with probability (1 - 0.8^4)^32 < 1e-7.

Edge cases: null, empty or blank texts have 0 shingles and are linked with
nothing; rows that share an id are one document for linking; rows with a null
id are linked with nothing, keep a null component and are kept; repeated rows
return one row each; very long texts are hashed whole, in a chunk of their own;
a similarity of exactly ``percent`` links; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored
from .components import components
from .textvec import chunks, mix64, segments, words

SHINGLE = 2
PERCENT = 80
PERMUTATIONS = 64
BANDS = 32
SEED = 2


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash), sorted and distinct within each text."""
    w = words(texts)
    n = len(w.hash)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    mult = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    first, docs = segments(w.doc)
    size = np.diff(np.append(first, n))
    full = max(n - k + 1, 0)
    acc = np.zeros(full, np.uint64)
    for j in range(k):
        acc += w.hash[j:j + full] * mult[j]
    ok = w.doc[:full] == w.doc[k - 1:k - 1 + full]
    doc, h = [w.doc[:full][ok]], [mix64(acc[ok])]
    for i in np.flatnonzero(size < k):               # texts of fewer words than a shingle has
        seq = w.hash[first[i]:first[i] + size[i]]
        doc.append(np.array([docs[i]]))
        h.append(mix64(np.array([(seq * mult[:size[i]]).sum() + np.uint64(size[i])], np.uint64)))
    doc, h = np.concatenate(doc), np.concatenate(h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(h) != 0)
    return doc[new], h[new]


def min_max(doc: np.ndarray, h: np.ndarray, permutations: int = PERMUTATIONS,
            seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima, each (permutations, texts with shingles)."""
    first, _ = segments(doc)
    key = mix64(np.arange(1, 2 * permutations + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * seed))
    a, b = key[:permutations] | np.uint64(1), key[permutations:]
    lo = np.empty((permutations, len(first)), np.uint64)
    hi = np.empty_like(lo)
    for i in range(permutations):
        x = h * a[i] + b[i]
        lo[i] = np.minimum.reduceat(x, first)
        hi[i] = np.maximum.reduceat(x, first)
    return lo, hi


def band_keys(lo: np.ndarray, hi: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(texts, bands): hash of a band's values, half minima and half maxima of other functions."""
    p = len(lo)
    each = p // bands
    out = np.empty((lo.shape[1], bands), np.uint64)
    for b in range(bands):
        acc = np.full(lo.shape[1], b + 1, np.uint64)
        for j in range(each):
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + lo[b * each + j])
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + hi[((b + 1) * each + j) % p])
        out[:, b] = acc
    return out


def signatures(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, s1, s2, bands): set size, two set hashes, band keys; bands is null for empty sets."""
    def run(batches):
        for b in chunks(batches):
            doc, h = shingles(b.column(1), k)
            rows = b.num_rows
            n = np.bincount(doc, minlength=rows)
            s1, s2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            offsets = np.zeros(rows + 1, np.int32)
            keys = np.empty(0, np.uint64)
            if len(h):
                first, at = segments(doc)
                s1[at] = np.add.reduceat(mix64(h), first)
                s2[at] = np.add.reduceat(mix64(h ^ np.uint64(0x5BD1E9955BD1E995)), first)
                keys = band_keys(*min_max(doc, h)).ravel()
                offsets[1:] = np.cumsum(n > 0) * BANDS
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64)))],
                names=["doc_id", "n", "s1", "s2", "bands"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, bands array<long>")


def shingle_set(text: str, k: int) -> set:
    """The set itself, as tuples of words."""
    w = text.encode("utf-8", "replace").lower().split()     # bytes: only A-Z and ASCII space
    if not w:
        return set()
    return set(zip(*(w[i:] for i in range(k)))) if len(w) >= k else {tuple(w)}


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with their texts ta, tb; rows of one a come one after the other."""
    return (pairs.join(texts.select(F.col("v").alias("b"), F.col("t").alias("tb")), "b")
            .join(texts.select(F.col("v").alias("a"), F.col("t").alias("ta")), "a"))


def _rows(batches, k: int):
    """(batch of at most 256 rows, [(set of a, set of b), ...]); the set of a run of equal a is built once."""
    last, left = None, set()
    for batch in batches:
        for b in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            sets = []
            for a, ta, tb in zip(b.column("a").to_pylist(), b.column("ta").to_pylist(), b.column("tb").to_pylist()):
                if a != last:
                    last, left = a, shingle_set(ta or "", k)
                sets.append((left, shingle_set(tb or "", k)))
            yield b, sets


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough: (a, b, common, total)."""
    def run(batches):
        for b, sets in _rows(batches, k):
            keep, common, total = [], [], []
            for i, (x, y) in enumerate(sets):
                c = len(x & y)
                u = len(x) + len(y) - c
                if c and 100 * c >= percent * u:
                    keep.append(i)
                    common.append(c)
                    total.append(u)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("a").take(at), b.column("b").take(at), pa.array(common, pa.int64()), pa.array(total, pa.int64())],
                names=["a", "b", "common", "total"])
    return _with_texts(pairs, texts).select("a", "b", "ta", "tb").mapInArrow(
        run, "a long, b long, common long, total long")


def differences(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Prefixes of the members' differences from their roots: (a, b, c, n, near, added, gone, half, items).

    ``items`` are hashes of the elements, additions first, each kind by hash: an
    order all members of a star share.  ``half`` elements meet members that are
    not linked to the root; an unlinked member shows up to n / 4 + 1 (at 80
    percent) of them, which meet any member.
    """
    q = (100 - percent) / (100 + percent)
    reach = (1 + 100 / percent) * q

    def key(e):
        return xxhash.xxh3_64_intdigest(b" ".join(e))

    def run(batches):
        for b, sets in _rows(batches, k):
            cols = ([], [], [], [], [], [])
            for x, y in sets:
                c = len(x & y)
                near = c > 0 and 100 * c >= percent * (len(x) + len(y) - c)
                items = sorted(map(key, y - x)) + sorted(map(key, x - y))
                half = int(len(items) * (1 + q) / 2) + 1
                size = half if near else max(half, int(len(y) * reach) + 1)
                values = np.array(items[:size], np.uint64).view(np.int64)
                for col, v in zip(cols, (len(y), near, len(y) - c, len(x) - c, half, values)):
                    col.append(v)
            ends = np.concatenate(([0], np.cumsum([len(v) for v in cols[5]]))).astype(np.int32)
            flat = np.concatenate([*cols[5], np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), b.column("c"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.bool_()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["a", "b", "c", "n", "near", "added", "gone", "half", "items"])
    return _with_texts(pairs, texts).select("a", "b", "c", "ta", "tb").mapInArrow(
        run, "a long, b long, c long, n long, near boolean, added long, gone long, half int, items array<long>")


def across(stars: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one star in different components that may be linked; stars: (a, b, c)."""
    q = (100 - percent) / (100 + percent)
    diff = stored(differences(stars, texts, k, percent), "dup-diff")
    rows = diff.select("a", F.col("b").alias("v"), "c", "n", "near", "added", "gone", "half",
                       F.posexplode("items").alias("pos", "item"))
    right = rows.where("pos < half").drop("half")
    left = rows.where("NOT near").select("a", "item", F.col("v").alias("xv"), F.col("c").alias("xc"), F.col("n").alias("xn"),
                                         F.col("added").alias("xa"), F.col("gone").alias("xg"), F.col("pos").alias("xpos"),
                                         (F.col("pos") < F.col("half")).alias("xhalf"))
    reach = q * (F.col("n") + F.col("xn")) + 1e-6                                        # most that |x ^ y| may be
    least = F.abs(F.col("added") - F.col("xa")) + F.abs(F.col("gone") - F.col("xg"))     # least that it is
    size, xsize = F.col("added") + F.col("gone"), F.col("xa") + F.col("xg")
    # if this is the first element they share, they share at most the rest of the shorter remainder
    most = F.least(size - F.col("pos"), xsize - F.col("xpos"))
    pairs = left.join(right, (left["a"] == right["a"]) & (left["item"] == right["item"]) & (F.col("c") != F.col("xc"))
                      & (F.col("near") | (F.col("xhalf") & (F.col("xv") < F.col("v"))))
                      & _size_ok(F.col("n"), F.col("xn"), percent) & (least <= reach)
                      & (size + xsize - 2 * most <= reach))
    return pairs.select(F.least("v", "xv").alias("a"), F.greatest("v", "xv").alias("b")).distinct()


def _size_ok(x, y, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def link(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id) of every document.

    ``class_id`` is the smallest id with the same set; ``kept`` marks the
    smallest id of each component.
    """
    sig = stored(signatures(docs, k, id_col, text_col), "dup-sig")
    real = sig.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(real.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("v"), F.first("bands").alias("bands")),
                     "dup-classes")
    slots = classes.select("v", "n", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bk"), "v", "n").distinct()
    shared = slots.groupBy("bk").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    slots = stored(slots.join(shared, "bk"), "dup-slots")             # of buckets with company only
    # the member that meets most others stands nearest to the middle of its family: the root of its buckets
    met = slots.groupBy("v").agg(F.sum("m").alias("met"))
    roots = (slots.join(met, "v").groupBy("bk")
             .agg(F.max(F.struct("met", F.negate("v").alias("w"), "n")).alias("root"))
             .select("bk", F.negate("root.w").alias("a"), F.col("root.n").alias("rn")))
    stars = stored(slots.join(roots, "bk").where("a <> v")
                   .select("a", F.col("v").alias("b"), _size_ok(F.col("n"), F.col("rn"), percent).alias("fits"))
                   .distinct(), "dup-stars")
    ids = stored(stars.select(F.explode(F.array("a", "b")).alias("v")).distinct(), "dup-ids")
    texts = docs.select(F.col(id_col).cast("long").alias("v"), F.col(text_col).alias("t"))
    texts = stored(texts.join(small_side(ids), "v", "left_semi").groupBy("v").agg(F.min("t").alias("t")), "dup-texts")
    links = stored(confirm(stars.where("fits").select("a", "b"), texts, k, percent), "dup-links")

    parts = components(links)
    named = (stars.select("a", "b").join(parts.withColumnRenamed("v", "b"), "b", "left")
             .select("a", "b", F.coalesce("component", "b").alias("c")))
    named = stored(named.join(parts.select(F.col("v").alias("a"), F.col("component").alias("root_c")), "a", "left")
                   .select("a", "b", "c", F.coalesce("root_c", "a").alias("root_c")), "dup-named")
    mixed = named.where("c <> root_c").select("a").distinct()     # stars with a member outside the root's component
    rest = across(named.select("a", "b", "c").join(mixed, "a", "left_semi"), texts, k, percent)
    seen = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(rest.join(seen, ["a", "b"], "left_anti"), "dup-rest")
    more = confirm(rest, texts, k, percent)
    # what is new connects whole components: only their names take part in the second round
    bridges = more.select("a", "b")
    for side in ("a", "b"):
        bridges = (bridges.join(parts.select(F.col("v").alias(side), F.col("component").alias("_c")), side, "left")
                   .withColumn(side, F.coalesce("_c", side)).drop("_c"))
    bridges = components(stored(bridges.where("a <> b"), "dup-bridges"))

    named_classes = (classes.select("n", "s1", "s2", F.col("v").alias("class_id"))
                     .join(parts, F.col("class_id") == F.col("v"), "left")
                     .withColumn("first", F.coalesce("component", "class_id")).drop("v", "component")
                     .join(bridges, F.col("first") == F.col("v"), "left")
                     .select("n", "s1", "s2", "class_id", F.coalesce("component", "first").alias("component_id")))
    out = sig.select("doc_id", "n", "s1", "s2").join(named_classes, ["n", "s1", "s2"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    own = F.when(F.col("doc_id").isNotNull(), own)
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))
