"""M2-M4: stratified block SGD (DSGD, Gemulla et al., KDD 2011) over block files.

One epoch is B sub-epochs; in sub-epoch s the B cells (a, (a + s) mod B) share
no user and no item, so they are trained in parallel, one task a cell.  User
blocks stay with their task's number and item blocks rotate; both are files in
the shared folder (``cells``), written anew after every sub-epoch, so a
sub-epoch is one flat job without a shuffle and its plan is the same whatever B.
With one block all epochs run in one task.  A fit of SHORT_STEPS sub-epochs or
more runs as barrier stages of GANG_EPOCHS epochs each: a task keeps its user
blocks and hands an item block on as a file to the task that needs it next, so
there is no job and no common wait between sub-epochs.  The steps and their
results are the same; a lost executor costs the stage it was part of.

Several fits over the same rows (a hyperparameter search) are trained by the
same jobs, one task per fit and block.  A fit can report its factors after
several epochs: rows, order and draws of an epoch depend on the epoch's number
alone, so a shorter fit is a prefix of a longer one.

B follows from the data alone (rows per cell, ids per block, and up to SGD_BLOCKS
tasks a step for all fits together) or is an argument; it is stored with the
model, so the same rows give the same factors whatever the number of cores.

Losses (per training row, in a hash order that changes with the epoch):
  svd       squared error with biases and a global mean (Funk SVD update)
  bpr       pairwise logistic on (u, i, j), j drawn from the item block (Rendle et al. 2009)
  warp      rank-weighted hinge with sampled violators (Weston et al. 2011)
  logistic  pointwise logistic, one drawn negative per positive
Inside a cell, rows are taken in batches that share no user and no item: row n
goes to the batch after the last one that holds its user or its item, and long
batches go in pieces of BATCH_ROWS rows.  For svd that equals the sequential
loop; the other losses also move the drawn negatives, whose gradients add up
within a piece.  Negatives come from the
current item block and are rejected when the user has a row for them there.

With ``weighted`` the gradients of bpr, warp and logistic are scaled by the
row's weight relative to the mean weight.  Rows of weight 0 are no positives but
are still rejected as negatives.  With ``adaptive`` every parameter has a step
of its own, lr / sqrt(1 + sum of its squared gradients so far) (AdaGrad, Duchi
et al. 2011); the sums travel with the blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from ..sources.blockfiles import drop_block, load_block, save_block
from .cells import (IDS_PER_BLOCK, ROWS_PER_CELL, Cells, block_ids, cell, factor_rows, gang_size, run_gang, run_tasks,
                    take_block)
from .factors import FactorModel

LOSSES = ("svd", "bpr", "warp", "logistic")
#: Tasks of a sub-epoch that the rows are cut for, over all fits.
SGD_BLOCKS = 12
#: Bytes of a block's factors (with their squared-gradient sums) that a task may hold; IDS_PER_BLOCK ids are always allowed.
#: Every item block is handed on once a sub-epoch, so an epoch moves blocks x items: few, large blocks move less.
BLOCK_BYTES = 128 << 20
#: Fits with fewer sub-epochs run one job each; longer ones run stages of GANG_EPOCHS epochs.
SHORT_STEPS = 8
GANG_EPOCHS = 10
#: Rows of a batch that are worked on at a time.
BATCH_ROWS = 1_024
#: User blocks that a task keeps between sub-epochs; what is more is written.
HELD_BYTES = 256 << 20


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _splitmix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 arrays (wrapping arithmetic)."""
    with np.errstate(over="ignore"):
        z = x + _GOLDEN
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def init_matrix(ids: np.ndarray, f: int, side: str, seed: int, gaussian: bool, scale: float) -> np.ndarray:
    """Deterministic initial vectors for many ids at once: N(0, scale) by Box-Muller over two
    hashed uniform streams, or uniform (u - 0.5) * scale.  Depends only on (id, dim, side, seed)."""
    with np.errstate(over="ignore"):
        base = _splitmix64(_splitmix64(ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 if side == "user" else 2))
                           ^ np.uint64(seed))
        d = np.arange(f, dtype=np.uint64)
        ha = _splitmix64(base[:, None] + d[None, :] * np.uint64(2) * _GOLDEN)
        u1 = ((ha >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53          # (0, 1)
        if not gaussian:
            return (u1 - 0.5) * scale
        hb = _splitmix64(base[:, None] + (d[None, :] * np.uint64(2) + np.uint64(1)) * _GOLDEN)
        u2 = (hb >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        return np.sqrt(-2.0 * np.log(u1)) * np.cos(2.0 * np.pi * u2) * scale


def init_vector(ident: int, f: int, side: str, seed: int, gaussian: bool, scale: float) -> np.ndarray:
    return init_matrix(np.array([ident]), f, side, seed, gaussian, scale)[0]


def row_order(u: np.ndarray, i: np.ndarray, epoch: int, seed: int) -> np.ndarray:
    """Hash that orders a cell's rows in an epoch."""
    with np.errstate(over="ignore"):
        x = _splitmix64(u.astype(np.int64).view(np.uint64)) + np.uint64(epoch)
        return _splitmix64(_splitmix64(x ^ i.astype(np.int64).view(np.uint64)) + np.uint64(seed))


def batches(u: np.ndarray, i: np.ndarray):
    """``conflict_free`` batches in pieces of at most BATCH_ROWS rows, whose gradients stay in a core's cache."""
    for at in conflict_free(u, i):
        for lo in range(0, len(at), BATCH_ROWS):
            yield at[lo:lo + BATCH_ROWS]


def _followers(x: np.ndarray) -> np.ndarray:
    """Place of the next equal value, or len(x)."""
    order = np.argsort(x, kind="stable")
    out = np.full(len(x), len(x))
    same = x[order][1:] == x[order][:-1]
    out[order[:-1][same]] = order[1:][same]
    return out


def conflict_free(u: np.ndarray, i: np.ndarray) -> list[np.ndarray]:
    """Row numbers of each batch: no user and no item twice in it, order kept along every user and item.

    A row is free once the row before it of its user and that of its item are
    taken; each round takes all free rows.
    """
    n = len(u)
    after = (_followers(u), _followers(i))
    waits = np.zeros(n + 1, np.int8)
    for f in after:
        waits[f[f < n]] += 1
    batches, free = [], np.flatnonzero(waits[:n] == 0)
    while len(free):
        batches.append(free)
        step = [f[free] for f in after]
        for x in step:
            waits[x] -= 1            # the followers of one batch along one side are distinct rows
        waits[n] = 1                 # no row
        both = np.concatenate(step)
        free = np.unique(both[waits[both] == 0])
    return batches


class Negatives:
    """Draws, per row, an item of the block that is no item of the row's user."""

    def __init__(self, u: np.ndarray, i: np.ndarray, n_users: int, n_items: int, rng: np.random.Generator):
        self.keys, self.n, self.rng = np.sort(u * n_items + i), n_items, rng
        self.free = np.bincount(np.unique(self.keys) // n_items, minlength=n_users) < n_items

    def draw(self, u: np.ndarray) -> np.ndarray:
        """Item per row, -1 where the user has a row for every item."""
        out = np.full(len(u), -1)
        todo = np.flatnonzero(self.free[u])
        while len(todo):
            j = self.rng.integers(self.n, size=len(todo))
            key = u[todo] * self.n + j
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fine = self.keys[at] != key
            out[todo[fine]] = j[fine]
            todo = todo[~fine]
        return out


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50.0, 50.0)))


class Side:
    """Factors and biases of a block, with the squared-gradient sums of adaptive steps."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, b: np.ndarray, gm: np.ndarray | None = None,
                 gb: np.ndarray | None = None):
        self.ids, self.m, self.b, self.gm, self.gb = ids, m, b, gm, gb

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: v for k, v in vars(self).items() if v is not None}

    def move(self, at: np.ndarray, grad: np.ndarray, grad_b: np.ndarray | None, lr: float) -> None:
        """A step along ``grad`` at rows ``at``; gradients of a repeated row add up."""
        if len(at) == 0:
            return
        order = np.argsort(at, kind="stable")
        repeat = at[order][1:] == at[order][:-1]
        adaptive, square, square_b = self.gm is not None, None, None
        if repeat.any():                                     # only repeated rows are added up: most are not
            many = np.zeros(len(at), bool)
            many[order[1:][repeat]] = many[order[:-1][repeat]] = True
            order, once = order[many[order]], ~many
            first = np.concatenate(([0], np.flatnonzero(np.diff(at[order])) + 1))
            total = lambda x: np.concatenate((x[once], np.add.reduceat(x[order], first)))
            squares = lambda x: np.concatenate((x[once] ** 2, np.add.reduceat(x[order] ** 2, first)))
            square = squares(grad) if adaptive else None
            square_b = squares(grad_b) if adaptive and grad_b is not None else None
            at, grad = np.concatenate((at[once], at[order][first])), total(grad)
            grad_b = None if grad_b is None else total(grad_b)
        elif adaptive:
            square, square_b = grad * grad, None if grad_b is None else grad_b * grad_b
        if not adaptive:
            self.m[at] += lr * grad
            if grad_b is not None:
                self.b[at] += lr * grad_b
            return
        so_far = self.gm[at]
        self.m[at] += lr * grad / np.sqrt(so_far)
        self.gm[at] = so_far + square
        if grad_b is not None:
            self.b[at] += lr * grad_b / np.sqrt(self.gb[at])
            self.gb[at] += square_b


def _dots(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.einsum("nf,nf->n", p, q)


def train_cell(fit: "Fit", U: Side, V: Side, u, i, r, order, mu: float, rng: np.random.Generator, n_items_total: int,
               mean_weight: float = 1.0) -> None:
    """One pass over a cell, in place; u and i are places in the two sides, r holds ratings or weights."""
    if len(u) == 0 or len(V.ids) == 0:
        return
    lr, reg = fit.lr, fit.reg
    if fit.loss == "svd":
        u, i, r = u[order], i[order], r[order]
        for at in batches(u, i):
            a, b = u[at], i[at]
            p, q = U.m[a], V.m[b]
            err = r[at] - (mu + U.b[a] + V.b[b] + (p * q).sum(axis=1))
            U.b[a] += lr * (err - reg * U.b[a])
            V.b[b] += lr * (err - reg * V.b[b])
            U.m[a] = p + lr * (err[:, None] * q - reg * p)
            V.m[b] = q + lr * (err[:, None] * p - reg * q)
        return
    negatives = Negatives(u, i, len(U.ids), len(V.ids), rng)
    order = order[r[order] != 0]                         # weight 0: known to the user, no positive
    u, i, r = u[order], i[order], r[order]
    scale = r / mean_weight if fit.weighted else np.ones(len(r))
    for at in batches(u, i):
        a, b, w = u[at], i[at], scale[at]
        j = negatives.draw(a)
        if fit.loss == "warp":
            trial = np.ones(len(at))
            p, qb = U.m[a], V.m[b]
            good = _dots(p, qb) + V.b[b]
            open_ = np.flatnonzero(j >= 0)
            hit = np.zeros(len(at), bool)
            for t in range(1, fit.max_trials + 1):
                bad = _dots(p[open_], V.m[j[open_]]) + V.b[j[open_]] > good[open_] - 1.0
                hit[open_[bad]], trial[open_[bad]] = True, t
                open_ = open_[~bad]
                if len(open_) == 0 or t == fit.max_trials:
                    break
                j[open_] = negatives.draw(a[open_])
            rank = np.maximum(1, (n_items_total - 1) // trial)
            a, b, j, w, g = a[hit], b[hit], j[hit], w[hit], np.log(rank[hit])
            p, qb, qj = p[hit], qb[hit], V.m[j]
        elif fit.loss == "bpr":
            ok = j >= 0
            a, b, j, w = a[ok], b[ok], j[ok], w[ok]
            p, qb, qj = U.m[a], V.m[b], V.m[j]
            g = _sigmoid(-(_dots(p, qb - qj) + V.b[b] - V.b[j]))
        else:
            ok = j >= 0
            _pointwise(U, V, a, b, np.ones(len(a)), w, lr, reg)
            _pointwise(U, V, a[ok], j[ok], np.zeros(int(ok.sum())), w[ok], lr, reg)
            continue
        wg, wr = w * g, w * reg
        grad_u, grad_b = wg[:, None] * (qb - qj), wg[:, None] * p
        grad_j = -grad_b
        if reg:
            grad_u -= wr[:, None] * p
            grad_b -= wr[:, None] * qb
            grad_j -= wr[:, None] * qj
        bias_b, bias_j = wg - wr * V.b[b], -wg - wr * V.b[j]
        U.move(a, grad_u, None, lr)
        V.move(np.concatenate((b, j)), np.concatenate((grad_b, grad_j)), np.concatenate((bias_b, bias_j)), lr)


def _pointwise(U: Side, V: Side, a, j, y, w, lr, reg):
    p, q = U.m[a], V.m[j]
    g = y - _sigmoid(_dots(p, q) + U.b[a] + V.b[j])
    bias_u, bias_v = w * (g - reg * U.b[a]), w * (g - reg * V.b[j])
    wg, wr = w * g, w * reg
    grad_u, grad_v = wg[:, None] * q, wg[:, None] * p
    if reg:
        grad_u -= wr[:, None] * p
        grad_v -= wr[:, None] * q
    U.move(a, grad_u, bias_u, lr)
    V.move(j, grad_v, bias_v, lr)


@dataclass(frozen=True)
class Fit:
    """One model to train; ``report`` lists epochs after which its factors are kept (the last one always is)."""
    loss: str
    factors: int
    epochs: int
    lr: float
    reg: float
    seed: int = 42
    init_std: float = 0.1
    gaussian_init: bool = True
    weighted: bool = False
    adaptive: bool = False
    max_trials: int = 10
    report: tuple[int, ...] = ()

    def __post_init__(self):
        if self.loss not in LOSSES:
            raise ValueError(f"loss must be one of {LOSSES}")

    @property
    def kept(self) -> tuple[int, ...]:
        return tuple(sorted({*self.report, self.epochs}))


def _side(folder: str, fit: Fit, n: int, side: str, block: int, step: int) -> Side:
    """A block's factors after ``step`` steps; before the first one they follow from the ids."""
    if step:
        f = load_block(folder, f"{n}-{side[0]}-{block}-{step}")
        return Side(**f)
    ids = block_ids(folder, side, block)
    m = init_matrix(ids, fit.factors, side, fit.seed, fit.gaussian_init,
                    fit.init_std if fit.gaussian_init else 1.0 / fit.factors)
    ones = (np.ones_like(m), np.ones(len(ids))) if fit.adaptive else (None, None)
    return Side(ids, m, np.zeros(len(ids)), *ones)


def ids_of_a_block(fits: list[Fit]) -> int:
    """Ids of a block whose factors take BLOCK_BYTES in the widest of ``fits``, and IDS_PER_BLOCK at least."""
    return max(IDS_PER_BLOCK, BLOCK_BYTES // max(8 * (f.factors + 1) * (2 if f.adaptive else 1) for f in fits))


def fit_blocks(rows: DataFrame, fits: list[Fit], blocks: int | None = None, rows_per_cell: int = ROWS_PER_CELL,
               ids_per_block: int | None = None) -> list[dict[int, FactorModel]]:
    """Train all ``fits`` on rows (u, i, r); per fit the models after its kept epochs, keyed by raw ids."""
    ids_per_block = ids_per_block or ids_of_a_block(fits)
    c = Cells(rows, blocks, rows_per_cell, ids_per_block, -(-SGD_BLOCKS // len(fits)))
    folder, nb, n_items, weight = c.folder, c.blocks, c.n_items, c.weight
    means = [c.mean if f.loss == "svd" else 0.0 for f in fits]

    def step(n: int, a: int, t: int, U: Side, V: Side, rows: tuple) -> None:
        """Step t + 1 of fit n on user block a: sub-epoch t mod B of epoch t div B, in place."""
        u, i, raw_u, raw_i, r = rows
        epoch, sub = divmod(t, nb)
        order = np.argsort(row_order(raw_u, raw_i, epoch, fits[n].seed), kind="stable")
        rng = np.random.default_rng([fits[n].seed, epoch, sub, a])
        train_cell(fits[n], U, V, u, i, r, order, means[n], rng, n_items, weight)

    def reported(n: int, t: int) -> bool:
        return t % nb == 0 and t // nb in fits[n].kept

    def train(n: int, a: int, first: int, last: int) -> None:
        """Steps first + 1 .. last of fit n on user block a, the item block of the first one all along."""
        fit = fits[n]
        b = (a + first) % nb
        U, V = _side(folder, fit, n, "user", a, first), _side(folder, fit, n, "item", b, first)
        rows = cell(folder, a, b, U.ids, V.ids)
        for t in range(first, last):
            step(n, a, t, U, V, rows)
            if t + 1 == last or reported(n, t + 1):
                save_block(folder, f"{n}-u-{a}-{t + 1}", **U.arrays())
                save_block(folder, f"{n}-i-{b}-{t + 1}", **V.arrays())
        if nb > 1 and first > 1 and not reported(n, first - 1):
            drop_block(folder, f"{n}-u-{a}-{first - 1}")        # two steps ago: no task reads it any more
            drop_block(folder, f"{n}-i-{b}-{first - 1}")

    def gang(own: list[tuple[int, int]], first: int, last: int, token: str) -> None:
        """Steps first + 1 .. last of the (fit, user block) pairs ``own``; item blocks come from and go to other tasks.

        Steps are taken in rising order, and a step needs an item block of the step before only: no task waits for ever.
        """
        passed, held = f"{folder}/{token}", {}
        for t in range(first, last):
            for n, a in own:
                end = min(last, fits[n].epochs * nb)
                if t >= end:
                    continue
                b = (a + t) % nb
                V = _side(folder, fits[n], n, "item", b, t) if t == first else Side(**take_block(passed, f"{n}-i-{b}-{t}"))
                U = held.pop((n, a), None)
                if U is None:
                    U = _side(folder, fits[n], n, "user", a, t) if t == first else Side(**take_block(passed, f"{n}-u-{a}-{t}"))
                step(n, a, t, U, V, cell(folder, a, b, U.ids, V.ids))
                if t + 1 == end or reported(n, t + 1):
                    save_block(folder, f"{n}-u-{a}-{t + 1}", **U.arrays())
                    save_block(folder, f"{n}-i-{b}-{t + 1}", **V.arrays())
                if t + 1 < end:
                    save_block(passed, f"{n}-i-{b}-{t + 1}", **V.arrays())
                    if sum(x.nbytes for y in (*held.values(), U) for x in y.arrays().values()) <= HELD_BYTES:
                        held[n, a] = U
                    else:
                        save_block(passed, f"{n}-u-{a}-{t + 1}", **U.arrays())

    heavy = sorted(range(len(fits)), key=lambda n: -fits[n].factors * fits[n].epochs)
    spark = rows.sparkSession
    if nb == 1:
        run_tasks(spark, [n for n in heavy if fits[n].epochs], lambda n: train(n, 0, 0, fits[n].epochs))
    else:
        steps = max(f.epochs for f in fits) * nb
        pairs = [(n, a) for n in heavy for a in range(nb)]
        size = min(gang_size(spark), len(pairs)) if steps >= SHORT_STEPS else 0
        if size > 1:
            for first in range(0, steps, GANG_EPOCHS * nb):
                last = min(first + GANG_EPOCHS * nb, steps)
                run_gang(spark, size, lambda k, token, first=first, last=last: gang(pairs[k::size], first, last, token))
                done = [(n, a) for n, a in pairs if first and fits[n].epochs * nb > first and not reported(n, first)]
                for n, a in done:                               # the stage is over: nobody starts from these any more
                    drop_block(folder, f"{n}-u-{a}-{first}")
                    drop_block(folder, f"{n}-i-{a}-{first}")
        else:
            for t in range(steps):
                run_tasks(spark, [(n, a) for n in heavy if fits[n].epochs * nb > t for a in range(nb)],
                          lambda x, t=t: train(x[0], x[1], t, t + 1))
    for n, f in enumerate(fits):
        if 0 in f.kept:
            run_tasks(spark, list(range(nb)), lambda a, n=n, f=f: [
                save_block(folder, f"{n}-{s[0]}-{a}-0", **_side(folder, f, n, s, a, 0).arrays()) for s in ("user", "item")])

    def model(n: int, epoch: int) -> FactorModel:
        f = fits[n]
        user, item = ([f"{n}-{s}-{k}-{epoch * nb}" for k in range(nb)] for s in "ui")
        return FactorModel("svd" if f.loss == "svd" else "biased", factor_rows(spark, folder, user),
                           factor_rows(spark, folder, item), global_mean=means[n], divisor=1.0,
                           user_files=[(folder, x) for x in user], item_files=[(folder, x) for x in item],
                           params={"loss": f.loss, "factors": f.factors, "epochs": epoch, "lr": f.lr, "reg": f.reg,
                                   "seed": f.seed, "blocks": nb, "weighted": f.weighted, "adaptive": f.adaptive,
                                   "max_trials": f.max_trials})
    return [{e: model(n, e) for e in f.kept} for n, f in enumerate(fits)]


def train_block_sgd(rows: DataFrame, loss: str, factors: int, epochs: int, lr: float, reg: float,
                    seed: int = 42, blocks: int | None = None, init_std: float = 0.1,
                    gaussian_init: bool = True, rows_per_cell: int = ROWS_PER_CELL,
                    ids_per_block: int | None = None, weighted: bool = False, adaptive: bool = False,
                    max_trials: int = 10) -> FactorModel:
    """rows: (u long, i long, r double) training cells. Returns a FactorModel keyed by raw ids.

    ``max_trials`` bounds the negatives that warp draws for a positive; a
    positive without a violator among them makes no step.
    """
    fit = Fit(loss, factors, epochs, lr, reg, seed, init_std, gaussian_init, weighted, adaptive, max_trials)
    return fit_blocks(rows, [fit], blocks, rows_per_cell, ids_per_block)[0][epochs]
