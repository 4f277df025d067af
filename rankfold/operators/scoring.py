"""User x item scoring with exclusions and per-user top-K, item blocks skipped by a bound.

Item factors are dealt to cells of near items (cut along the coordinates, the
length among them, that spread most) and written as a block file each into the
shared folder; seen pairs are written as one file per user block.  Users are
hashed into blocks, and each block is one task that streams the item blocks past
its users.  For a user with factor p no item of a block can score more than
``mu + (b_u + max b_i + min(|p| max|q|, max of p.q over the box around the block))
/ divisor``; each user meets the block of the largest bound first, and once a
user holds K items, blocks whose bound is below the K-th score are skipped for
that user, which leaves the lists exact (a tie counts as not below unless all ids
of the block lose it).  Within a block near items form leaves, which are skipped
alike by the box around them; a leaf is multiplied in single precision, and what
may enter a list by that, its rounding included, is scored in double.  Where
scores are clipped, the items of smallest ids give a first bound: a user for
whom K of them reach the upper clip needs no item of a larger id.  Nothing is
shuffled but the user factors, the item factors and the seen pairs, once each; no
user x item pair is ever a row, and a task holds its users, their seen pairs and
one item block at a time.

The cuts come from a hashed choice of at most about LAYOUT_ITEMS items; all items
are dealt by them, so they change the layout only, never the lists.

Several models over the same users, items and seen pairs are scored by the same
jobs (``score_many``).  The number of blocks follows the sizes, and for small
inputs the number of cores; that changes the layout only, never the lists.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path
from ..sources.blockfiles import load_block, save_block
from .cells import tagged_rows
from .factors import FactorModel

_OUT = "model string, u long, i long, score double, rank int"
_WRITTEN = "model string, file string, n long, reach double, bias double, low long, hi array<double>, lo array<double>"
BLOCK_USERS = 32_768
BLOCK_ITEMS = 32_768
#: Items of a block that are bounded and multiplied together.
LEAF_ITEMS = 128
#: Items that give a clipped score's ties, or the first floors: they bound the lists, which are exact whatever their number.
HEAD_ITEMS = 2_048
FIRST_ITEMS = 2_048
#: Items that the cells are laid out by; every item is dealt to its cell, and the lists are exact whatever the cells.
LAYOUT_ITEMS = 16_384


def _user_blocks(n_users: int, models: int, parallelism: int, max_users: int) -> int:
    n = max(1, math.ceil(n_users / max_users))
    # enough tasks to keep every core busy, without splitting blocks below ~256 users
    while n * models < 4 * parallelism and n_users / (n * 2) >= 256:
        n *= 2
    return n


def _local_topk(est: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of every row's top k of ``est``: score desc, then column asc; -inf never appears.

    np.partition finds each row's k-th largest score in linear time; only the
    entries at or above it (ties included) are sorted.
    """
    n = est.shape[1]
    kk = min(k, n)
    kth = np.partition(est, n - kk, axis=1)[:, n - kk]
    r, c = np.nonzero((est >= kth[:, None]) & np.isfinite(est))
    v = est[r, c]
    order = np.lexsort((c, -v, r))
    r, c, v = r[order], c[order], v[order]
    keep = (np.arange(len(r)) - np.searchsorted(r, r, side="left")) < kk
    return r[keep], c[keep], v[keep]


def _places(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted id in rising ``ids``, and whether it is there."""
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return at, ids[at] == wanted


class Lists:
    """The best k (score desc, item asc) of every user of a block so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.item = np.full((n, k), np.iinfo(np.int64).max)

    def merge(self, users: np.ndarray, row: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        """Take up candidates of ``users[row]``."""
        if len(row) == 0:
            return
        hit, row = np.unique(row, return_inverse=True)
        users = users[hit]
        r = np.concatenate((np.repeat(np.arange(len(users)), self.k), row))
        s = np.concatenate((self.score[users].ravel(), score))
        i = np.concatenate((self.item[users].ravel(), item))
        order = np.lexsort((i, -s, r))
        r, s, i = r[order], s[order], i[order]
        at = np.arange(len(r)) - np.searchsorted(r, r, side="left")
        keep = at < self.k
        self.score[users[r[keep]], at[keep]] = s[keep]
        self.item[users[r[keep]], at[keep]] = i[keep]


def _near_order(m: np.ndarray, leaf: int) -> np.ndarray:
    """Rows so ordered that every ``leaf`` consecutive ones lie close together: halved along the widest component."""
    out, todo = [], [np.arange(len(m))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        own = m[rows]
        spread = own.max(axis=0) - own.min(axis=0)
        # equal rows: by their place
        wide = own[:, int(np.argmax(spread))] if len(spread) and spread.max() > 0 else rows
        half = leaf * math.ceil(len(rows) / leaf / 2)              # whole leaves on the left
        order = np.argpartition(wide, half - 1)
        todo += [rows[order[half:]], rows[order[:half]]]
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _coordinates(m: np.ndarray, bias: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """What items are dealt out by: components, bias, length, and the id where all these are equal."""
    x = np.column_stack((m, bias, np.sqrt((m * m).sum(axis=1)), ids))
    return np.nan_to_num(x, nan=0.0, posinf=1e150, neginf=-1e150)


def _cuts(x: np.ndarray, parts: int, first: int = 0):
    """Tree of cuts (coordinate, value, left, right) that deals rows like ``x`` to ``parts`` cells; its ends are cell numbers."""
    if parts == 1 or len(x) == 0:
        return first
    spread = np.where(np.ptp(x[:, :-1], axis=0) > 0, x[:, :-1].std(axis=0), 0.0)
    c = int(np.argmax(spread)) if spread.max() > 0 else x.shape[1] - 1
    value = np.sort(x[:, c])
    at = value[len(value) * (parts // 2) // parts]
    below, upto = (np.searchsorted(value, at, side) / len(value) for side in ("left", "right"))
    if below == 0 or abs(upto - 0.5) < abs(below - 0.5):
        at, below = np.nextafter(at, np.inf), upto
    if below == 1:                                       # nothing to cut by
        return first
    n = min(max(round(parts * below), 1), parts - 1)
    left = x[:, c] < at
    return c, float(at), _cuts(x[left], n, first), _cuts(x[~left], parts - n, first + n)


def _cell(cuts, x: np.ndarray) -> np.ndarray:
    """Cell of every row of ``x``."""
    out, todo = np.zeros(len(x), np.int32), [(cuts, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not isinstance(node, tuple):
            out[rows] = node
            continue
        c, at, left, right = node
        low = x[rows, c] < at
        todo += [(left, rows[low]), (right, rows[~low])]
    return out


def _matrix(flat) -> np.ndarray:
    """Rows of a list column as a matrix."""
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    starts, width = flat.offsets.to_numpy(), flat.value_lengths().to_numpy()
    if len(width) and (width != width[0]).any():
        raise ValueError("item factors of different lengths")
    return flat.values.to_numpy()[starts[:-1][:, None] + np.arange(width[0] if len(width) else 0)]


def _dealer(cuts: dict):
    """Item rows with their cell (``part``) under their model."""
    def run(batches):
        for b in batches:
            part, tags = np.zeros(b.num_rows, np.int32), b.column("model").dictionary_encode()
            for n, model in enumerate(tags.dictionary.to_pylist()):
                at = np.flatnonzero(tags.indices.to_numpy() == n)
                own = b.take(pa.array(at))
                part[at] = _cell(cuts.get(model, 0), _coordinates(
                    _matrix(own.column("features")), own.column("bias").to_numpy(), own.column("id").to_numpy()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part, pa.int32())], names=[*b.schema.names, "part"])
    return run


def _writer(folder: str, number: dict[str, int], prefix: str = "items"):
    """The item rows of a model's cell, near ones together, as one block file; returns (model, file, size, bounds)."""
    def run(key, table):
        model, part = key[0].as_py(), key[1].as_py()
        ids, bias, m = table.column("id").to_numpy(), table.column("bias").to_numpy(), _matrix(table.column("features"))
        order = np.argsort(ids)                                    # equal rows give equal files
        order = order[_near_order(m[order], LEAF_ITEMS)]
        ids, bias, m = ids[order], bias[order], m[order]
        name = f"{prefix}-{number[model]}-{part}"
        save_block(folder, name, ids=ids, m=m, b=bias)
        row = (model, name, len(ids), float(np.sqrt((m * m).sum(axis=1)).max()), float(bias.max()), int(ids.min()),
               m.max(axis=0).tolist(), m.min(axis=0).tolist())
        box = pa.list_(pa.float64())
        types = (pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), box, box)
        return pa.table([pa.array([x], t) for x, t in zip(row, types)],
                        names=["model", "file", "n", "reach", "bias", "low", "hi", "lo"])
    return run


class _Users:
    """The users of a block under one model, the pairs they saw, their lists, and what an item must reach to enter one.

    An item enters a list by (score, id): it must score above ``floor``, or just
    that with an id of at most ``floor_id``.  Both rise from bounds that hold for
    every list (``raise_floor``) to the k-th entry.
    """

    def __init__(self, uid, P, bu, about, k: int, su, si):
        self.kind, self.mu, self.divisor, self.clip = about
        by_item = np.argsort(si, kind="stable")                      # a block looks its ids up here
        self.P, self.bu, self.k, self.su, self.si = P, bu, k, su[by_item], si[by_item]
        self.plus, self.minus = np.maximum(P, 0.0), np.minimum(P, 0.0)
        self.length = np.sqrt((P * P).sum(axis=1))
        self.best = Lists(len(uid), k)
        self.floor = np.full(len(uid), -np.inf)
        self.floor_id = np.full(len(uid), np.iinfo(np.int64).max)
        # components beyond single precision are compared in double
        self.type = np.float32 if P.size == 0 or np.abs(P).max() < 1e15 else np.float64
        self.coarse = np.concatenate((P, np.ones((len(uid), 1))), axis=1).astype(self.type)

    def score(self, raw):
        est = self.mu + raw / self.divisor
        return est if self.clip is None else np.clip(est, *self.clip)

    def raise_floor(self, users, score, ident) -> None:
        up = (score > self.floor[users]) | ((score == self.floor[users]) & (ident < self.floor_id[users]))
        self.floor[users[up]], self.floor_id[users[up]] = score[up], ident[up]

    def reachable(self, bound, low, users=slice(None)):
        """Whether items of ``bound`` and of ids from ``low`` on can enter the users' lists."""
        over = lambda x: x[users].reshape((-1,) + (1,) * (np.ndim(bound) - 1))
        return (bound > over(self.floor)) | ((bound == over(self.floor)) & (low <= over(self.floor_id)))

    def bound(self, reach, bias, box=()):
        """Bound of the scores against items of length up to ``reach``, bias up to ``bias``, and within ``box`` (top, bottom)."""
        raw, size = self.length * reach, reach
        if len(box):
            hi, lo = np.asarray(box[0], float), np.asarray(box[1], float)
            raw, size = np.minimum(self.plus @ hi + self.minus @ lo, raw), max(reach, np.sqrt(np.maximum(hi * hi, lo * lo).sum()))
        raw = raw + (self.bu + bias if self.kind != "dot" else 0.0)
        return self.score(raw + 1e-9 * (1.0 + np.abs(raw) + self.length * size))

    def margin(self, users, block):
        """What a coarse score may be off."""
        eps = float(np.finfo(self.type).eps)
        return 4 * (self.P.shape[1] + 8) * eps * (self.length[users] * block.reach + block.top + np.abs(self.bu[users])) + 1e-30

    def threshold(self, users, block):
        """The coarse score (without the user's bias) that an item needs to enter the list."""
        floor = self.floor[users]
        raw = (floor - self.mu) * self.divisor
        if self.clip is not None:
            raw = np.where(floor <= self.clip[0], -np.inf, raw)
        off = self.margin(users, block) + 1e-9 * (np.abs(np.where(np.isfinite(raw), raw, 0.0)) + abs(self.mu * self.divisor))
        # rounded towards less
        return np.nextafter((raw - self.bu[users] - off).astype(self.type), self.type(-np.inf))


class _Block:
    """A block file of items, cut into leaves of near items with their bounds."""

    def __init__(self, folder: str, file: str, own: _Users):
        f = load_block(folder, file)
        self.ids, self.m, self.b = f["ids"], f["m"], f["b"] if own.kind != "dot" else np.zeros(len(f["ids"]))
        self.starts = np.arange(0, len(self.ids), LEAF_ITEMS)
        lengths = np.sqrt((self.m * self.m).sum(axis=1))
        self.lengths, self.reach, self.top = lengths, lengths.max(), np.abs(self.b).max()
        if own.type is np.float32 and not max(np.abs(self.m).max(), self.top) < 1e15:
            own.type, own.coarse = np.float64, own.coarse.astype(np.float64)
        self.coarse = np.concatenate((self.m, self.b[:, None]), axis=1).astype(own.type)
        order = np.argsort(self.ids)
        # the block's ids among the seen pairs, not all pairs among its ids: a task opens many blocks
        first, end = (np.searchsorted(own.si, self.ids[order], side) for side in ("left", "right"))
        n = end - first
        self.seen_item = np.repeat(order, n)
        self.seen_user = own.su[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        self.seen = np.sort(self.seen_user * len(self.ids) + self.seen_item)
        self.hi, self.lo = np.maximum.reduceat(self.m, self.starts), np.minimum.reduceat(self.m, self.starts)
        self.far, self.bias = np.maximum.reduceat(self.lengths, self.starts), np.maximum.reduceat(self.b, self.starts)
        self.lows = np.minimum.reduceat(self.ids, self.starts)

    def leaf(self, n: int) -> slice:
        return slice(self.starts[n], min(self.starts[n] + LEAF_ITEMS, len(self.ids)))

    def bounds(self, own: _Users, users: np.ndarray) -> np.ndarray:
        """users x leaves: no item of the leaf scores more, by the box around it and by its longest item."""
        hi, lo = self.hi, self.lo
        far = own.length[users, None] * self.far[None, :]
        raw = np.minimum(own.plus[users] @ hi.T + own.minus[users] @ lo.T, far) + own.bu[users, None] + self.bias[None, :]
        # the box's terms may cancel: the slack follows their size, not the sum's
        box = np.sqrt(np.maximum(hi * hi, lo * lo).sum(axis=1))
        raw += 1e-9 * (1.0 + np.abs(raw) + own.length[users, None] * box[None, :])
        return own.score(raw)

    def unseen(self, users: np.ndarray, items: np.ndarray) -> np.ndarray:
        if len(self.seen) == 0:
            return np.ones(len(users), bool)
        return ~_places(self.seen, users * len(self.ids) + items)[1]

    def first_floor(self, own: _Users, asked: np.ndarray, chunk: int) -> None:
        """Floors of the users ``asked`` from the longest items of the block: k unseen ones score at least that."""
        items = np.argsort(-self.lengths, kind="stable")[:FIRST_ITEMS]
        if len(items) < own.k:
            return
        place = np.full(len(self.ids), -1)
        place[items] = np.arange(len(items))
        sp = place[self.seen_item]
        su, sp = self.seen_user[sp >= 0], sp[sp >= 0]
        for s in range(0, len(asked), chunk):
            users = asked[s:s + chunk]
            raw = own.coarse[users] @ self.coarse[items].T
            at, mine = _places(users, su)
            raw[at[mine], sp[mine]] = -np.inf
            kth = np.partition(raw, len(items) - own.k, axis=1)[:, len(items) - own.k].astype(np.float64)
            est = own.score(kth + own.bu[users] - own.margin(users, self))
            est = est - 1e-9 * (np.abs(est) + abs(own.mu))
            fine = np.isfinite(kth)
            own.raise_floor(users[fine], est[fine], np.full(int(fine.sum()), np.iinfo(np.int64).max))

    def clip_floor(self, own: _Users, chunk: int) -> None:
        """Floors from the smallest ids of all: k unseen ones at the upper clip, or any k of them at the lower clip."""
        order = np.argsort(self.ids)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        for s in range(0, len(own.P), chunk):
            users = np.arange(s, min(s + chunk, len(own.P)))
            raw = (own.coarse[users] @ self.coarse[order].T).astype(np.float64) + own.bu[users, None]
            off = own.margin(users, self)
            top = (own.clip[1] - own.mu) * own.divisor
            open_ = np.ones(raw.shape, bool)
            mine = (self.seen_user >= s) & (self.seen_user < s + chunk)
            open_[self.seen_user[mine] - s, place[self.seen_item[mine]]] = False
            sure = raw >= (top + 1e-9 * (1.0 + abs(top) + abs(own.mu * own.divisor)) + off)[:, None]
            for level, mask in ((own.clip[0], open_), (own.clip[1], open_ & sure)):
                count = np.cumsum(mask, axis=1, dtype=np.int32)
                full = np.flatnonzero(count[:, -1] >= own.k)
                at = (count[full] < own.k).sum(axis=1)                    # place of the k-th
                own.raise_floor(users[full], np.full(len(full), level), self.ids[order][at])

    def enter(self, own: _Users, users: np.ndarray, chunk: int) -> None:
        """All items of the block that can enter the lists of ``users``."""
        low = self.lows
        for s in range(0, len(users), chunk):
            some = users[s:s + chunk]
            bound = self.bounds(own, some)
            near = np.argmax(bound, axis=1)                      # each user's most promising leaf first: it raises the floor
            rows = np.arange(len(some))
            hit = own.reachable(bound, low[None, :], some)[rows, near]
            for leaf in np.unique(near[hit]):
                self.take(own, some[hit & (near == leaf)], leaf, chunk)
            bound[rows, near] = np.nan
            open_ = own.reachable(bound, low[None, :], some)
            for leaf in np.flatnonzero(open_.any(axis=0)):
                go = np.flatnonzero(open_[:, leaf])
                go = go[own.reachable(bound[go, leaf], low[leaf], some[go])]
                if len(go):
                    self.take(own, some[go], leaf, chunk)

    def take(self, own: _Users, users: np.ndarray, n: int, chunk: int) -> None:
        """The items of a leaf into the lists of ``users``: a coarse product first, the exact score of what is left."""
        leaf = self.leaf(n)
        items, ids = self.coarse[leaf].T, self.ids[leaf]
        for s in range(0, len(users), chunk):
            some = users[s:s + chunk]
            run = some[-1] - some[0] + 1 == len(some)                 # neighbours are not copied; ``users`` rise
            raw = (own.coarse[some[0]:some[-1] + 1] if run else own.coarse[some]) @ items
            hits = np.flatnonzero(raw >= own.threshold(some, self)[:, None])
            if len(hits) == 0:
                continue
            r, c = np.divmod(hits, raw.shape[1])
            u, i = some[r], c + leaf.start
            raw = np.einsum("ij,ij->i", own.P[u], self.m[i])
            if own.kind != "dot":
                raw = own.bu[u] + self.b[i] + raw
            est = own.score(raw)
            fine = np.isfinite(est) & own.reachable(est, self.ids[i], u)
            u, i, est = u[fine], i[fine], est[fine]
            free = self.unseen(u, i)
            u, i, est = u[free], i[free], est[free]
            if len(u) == 0:
                continue
            hit, row = np.unique(u, return_inverse=True)
            own.best.merge(hit, row, self.ids[i], est)
            own.raise_floor(hit, own.best.score[hit, -1], own.best.item[hit, -1])


def _scorer(folder: str, blocks: dict[str, list], models: dict[str, tuple], k: int, chunk: int,
            heads: dict[str, str] | None = None):
    """Lists of one user block under one model; ``blocks``: (file, reach, bias, smallest id, and the box around the items as
    its top and bottom) per model; ``heads``: a file of the items of smallest ids, for clipped models."""
    def run(key, table):
        name, ub = key[0].as_py(), key[1].as_py()
        uid = table.column("id").to_numpy()
        order = np.argsort(uid)
        uid = uid[order]
        P = table.column("features").combine_chunks().flatten().to_numpy().reshape(len(uid), -1)[order]
        bu = table.column("bias").to_numpy()[order] if models[name][0] != "dot" else np.zeros(len(uid))
        seen = load_block(folder, f"seen-{ub}")
        su, si = (seen["u"], seen["i"]) if seen else (np.empty(0, np.int64),) * 2
        su, known = _places(uid, su)
        own = _Users(uid, P, bu, models[name], k, su[known], si[known])
        if heads and name in heads:
            _Block(folder, heads[name], own).clip_floor(own, chunk)
        files = blocks[name]
        bound = np.stack([own.bound(reach, bias, more[1:]) for _, reach, bias, *more in files], axis=1)
        low = np.array([more[0] if more else np.iinfo(np.int64).min for _, _, _, *more in files])
        # each user's most promising block first: it raises the floor
        near = np.argmax(bound, axis=1)
        for n in np.unique(near):
            users = np.flatnonzero(near == n)
            users = users[own.reachable(bound[users, n], low[n], users)]
            if len(users):
                block = _Block(folder, files[n][0], own)
                block.first_floor(own, users, chunk)
                block.enter(own, users, chunk)
        for n in np.argsort(-bound.mean(axis=0), kind="stable"):
            users = np.flatnonzero(own.reachable(bound[:, n], low[n]) & (near != n))
            if len(users):
                _Block(folder, files[n][0], own).enter(own, users, chunk)
        best = own.best
        u, rank = np.nonzero(np.isfinite(best.score))
        return pa.table({"model": pa.array([name] * len(u), pa.string()), "u": pa.array(uid[u], pa.int64()),
                         "i": pa.array(best.item[u, rank], pa.int64()), "score": pa.array(best.score[u, rank]),
                         "rank": pa.array(rank + 1, pa.int32())})
    return run


def score_many(models: dict[str, FactorModel], users: DataFrame, k: int, seen: DataFrame | None = None,
               items: DataFrame | None = None, max_block_users: int = BLOCK_USERS,
               max_block_items: int = BLOCK_ITEMS, chunk: int = 2048, cold: DataFrame | None = None) -> DataFrame:
    """Top-k unseen items per requested user under each model.

    users: column ``u`` (raw ids; users without factors get no list);
    seen:  (u, i) pairs to exclude; items: optional candidate set (column ``i``);
    cold: users (column ``id``) without factors that get zero factors, so the item biases rank for them.
    Returns (model, u, i, score, rank) with rank 1..k in (score desc, i asc) order.
    """
    spark = users.sparkSession
    checkpoint_dir(spark)
    folder = scratch_path(spark, "topk")

    def tagged(side):
        files = [(name, *f) for name, m in models.items() for f in getattr(m, f"{side}_files") or ()]
        parts = [tagged_rows(spark, files)] if files else []
        parts += [getattr(m, f"{side}_factors").select(F.lit(name).alias("model"), "id", F.col("bias").cast("double")
                                                       .alias("bias"), "features")
                  for name, m in models.items() if getattr(m, f"{side}_files") is None]
        return reduce(DataFrame.unionByName, parts)
    asked = users.select(F.col("u").alias("id")).distinct()
    uf, itf = tagged("user"), tagged("item")
    if cold is not None:
        sizes = itf.groupBy("model").agg(F.max(F.size("features")).alias("f")).collect()      # a row per model
        zeros = F.explode(F.array(*[F.struct(F.lit(r["model"]).alias("model"), F.lit(r["f"]).alias("f")) for r in sizes]))
        uf = uf.unionByName(cold.select("id", zeros.alias("_z")).select(
            "_z.model", "id", F.lit(0.0).alias("bias"), F.array_repeat(F.lit(0.0), F.col("_z.f")).alias("features")))
    uf = uf.join(asked, "id", "left_semi")
    # sizes from the id sets, not from the factors: a few rows more than the models know do no harm
    n_users = asked.count()
    if items is not None:
        allowed = items.select(F.col("i").alias("id")).distinct()
        itf, n_items = itf.join(allowed, "id", "left_semi"), allowed.count() * len(models)
    else:
        n_items = itf.select("model", "id").count()
    if n_users == 0 or n_items == 0:
        return spark.createDataFrame([], _OUT)
    nu = _user_blocks(n_users, len(models), spark.sparkContext.defaultParallelism, max_block_users)
    number = {m: n for n, m in enumerate(models)}
    zero = [n for n, m in models.items() if m.kind == "dot"]                   # their biases count for nothing
    itf = itf.withColumn("bias", F.when(F.col("model").isin(zero), 0.0).otherwise(F.col("bias")))
    itf = itf.select("model", "id", "bias", "features")
    parts = math.ceil(n_items / len(models) / max_block_items)
    if parts > 1:
        some = itf.where(F.pmod(F.xxhash64("model", "id"), F.lit(max(1, n_items // LAYOUT_ITEMS))) == 0).toArrow()
        tags, cuts = np.array(some.column("model").to_pylist(), object), {}
        for m in models:
            mine = some.filter(pa.array(tags == m))
            if mine.num_rows:
                cuts[m] = _cuts(_coordinates(_matrix(mine.column("features")), mine.column("bias").to_numpy(),
                                             mine.column("id").to_numpy()), parts)
        dealt = itf.mapInArrow(_dealer(cuts), "model string, id long, bias double, features array<double>, part int")
    else:
        dealt = itf.withColumn("part", F.lit(0))
    written = dealt.groupBy("model", "part").applyInArrow(_writer(folder, number), _WRITTEN).collect()   # a row per block
    blocks = {m: [(r["file"], r["reach"], r["bias"], r["low"], r["hi"], r["lo"])
                  for r in sorted(written, key=lambda r: r["file"]) if r["model"] == m] for m in models}
    heads = {}
    for m in models:
        if models[m].clip is not None:
            head = itf.where(F.col("model") == m).orderBy("id").limit(HEAD_ITEMS).withColumn("part", F.lit(0))
            rows = head.groupBy("model", "part").applyInArrow(_writer(folder, number, "head"), _WRITTEN).collect()
            heads |= {r["model"]: r["file"] for r in rows}

    def block(col):
        return F.pmod(F.xxhash64(col, F.lit(17)), F.lit(nu)).cast("int")
    if seen is not None:
        def write_seen(key, table):
            u, i = table.column("u").to_numpy(), table.column("i").to_numpy()
            order = np.lexsort((i, u))
            save_block(folder, f"seen-{key[0].as_py()}", u=u[order], i=i[order])
            return pa.table({"n": pa.array([len(u)], pa.int64())})
        pairs = seen.select("u", "i").distinct().join(asked.withColumnRenamed("id", "u"), "u", "left_semi")
        (pairs.withColumn("ub", block(F.col("u"))).groupBy("ub").applyInArrow(write_seen, "n long")
         .agg(F.sum("n")).collect())
    about = {n: (m.kind, float(m.global_mean), float(m.divisor), m.clip) for n, m in models.items()}
    lists = (uf.withColumn("ub", block(F.col("id"))).repartition(min(2 * nu * len(models), 4096), "model", "ub")
             .groupBy("model", "ub").applyInArrow(_scorer(folder, blocks, about, k, chunk, heads), _OUT))
    # k rows per user: written once to the shared checkpoint folder, so later
    # uses (fusion, metrics) neither rerun the Python stage nor depend on it
    return lists.checkpoint(eager=True)


def score_topk(model: FactorModel, users: DataFrame, k: int, seen: DataFrame | None = None,
               items: DataFrame | None = None, max_block_users: int = BLOCK_USERS,
               max_block_items: int = BLOCK_ITEMS, chunk: int = 2048) -> DataFrame:
    """(u, i, score, rank) of one model: see ``score_many``."""
    return score_many({"": model}, users, k, seen, items, max_block_users, max_block_items, chunk).drop("model")
