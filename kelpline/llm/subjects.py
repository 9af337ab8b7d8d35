"""Subjects of documents: passages in a latent term space, clustered by bisecting k-means, subjects from leaf mixtures.

1. From labelled documents (a bounded sample, ``MAX_LABELLED`` and ``MAX_CHARS``) the discriminative terms are chosen, those
   with a lift for some subject, and the terms that mark passages which mention a subject without the document being
   about it ("... in the background").
2. The labelled documents' vectors of these terms are reduced to ``DIMENSIONS`` latent ones, in which terms that occur in
   the same documents lie close. No label enters here. A passage (sentence) is the normalised sum of its terms; one
   without such terms, or a passing mention (``MARKS`` marks or more), has no vector.
3. Bisecting k-means splits the labelled documents' passages into leaves, always the leaf with the largest spread next. A
   leaf is labelled by the terms closest to its centre. Its mixture of subjects is what the documents' labels give the
   passages in it (expectation maximisation over pairs of label set and leaf, counted over all labelled documents).
4. Every passage of every document falls into the leaf of the nearest centre, and deals with a subject that makes up
   ``PART`` of that leaf's mixture. A document is about the subjects that ``PASSAGES`` or more of its passages deal with.

Only steps 1 to 3 fit a classifier, on the bounded sample; all documents are classified, in one pass without a shuffle of texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Most subjects that are told apart.
SUBJECTS = 1_000
#: Labelled documents, and their characters in all, that terms and leaves are learnt from; chosen by hash, whole texts only.
MAX_LABELLED, MAX_CHARS = 8_000, 16 << 20
#: Pseudo-observations that draw a term towards the base rates; least lift of a term, as a part of the greatest possible,
#: and least share; least score of a passage.
SMOOTH, LIFT, SHARE, SCORE = 3.0, 0.45, 0.4, 1.5
#: Latent dimensions, and leaves of the tree (fewer where there are fewer different passages).
DIMENSIONS, LEAVES = 100, 400
#: A passage deals with a subject that has this share of its leaf's mixture; a document is about what so many passages deal with.
PART, PASSAGES = 0.5, 2
#: So many marks make a passage a passing mention.
MARKS = 2

_TAG = re.compile(r"<[^<>]{0,200}>")
_CUT = re.compile(r"[\n\r  。！？!?]+|[.]+[)\"'\]»”]*(?:\s|$)")
_DIGITS = re.compile(r"\d+")
_CJK = re.compile("[぀-ヿ㐀-鿿豈-﫿가-힯]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|#")


def passages(text: str | None) -> list[str]:
    """The sentences and lines of a text in lower case, with numbers as ``#`` and without mark-up; none for null and blank texts."""
    if not text:
        return []
    t = _TAG.sub(" ", unicodedata.normalize("NFKC", text).lower())
    cut = (_DIGITS.sub("#", s).strip(" \t*-|_`>\"'()[]") for s in _CUT.split(t))
    return [s for s in cut if len(s) > 1]


def terms(passage: str) -> set[str]:
    """Words, pairs and triples of words; runs of one to four characters where words are not spaced.

    A word is known by its first letter and its other letters in alphabetical order, so swapped letters don't matter.
    """
    out: set[str] = set()
    for run in _CJK.findall(passage):
        for n in (1, 2, 3, 4):
            out.update(run[i : i + n] for i in range(len(run) - n + 1))
    w = [x if len(x) < 4 else x[0] + "".join(sorted(x[1:])) for x in _WORD.findall(_CJK.sub(" ", passage))]
    out.update(w)
    out.update(f"{a} {b}" for a, b in zip(w, w[1:]))
    out.update(f"{a} {b} {c}" for a, b, c in zip(w, w[1:], w[2:]))
    return out


def fit_terms(texts: list[str | None], labels: list[set[int]], subjects: list[int], rounds: int = 6) -> tuple[dict[str, np.ndarray], set[str]]:
    """Lifts of the discriminative terms, and the terms that mark passing mentions. No labelled texts give no terms."""
    k, at = len(subjects), {s: i for i, s in enumerate(subjects)}
    voc: dict[str, int] = {}
    known: dict[str, np.ndarray] = {}
    rows, own = [], []
    for d, text in enumerate(texts):
        for p in passages(text):
            f = known.get(p)
            if f is None:
                f = known[p] = np.array([voc.setdefault(x, len(voc)) for x in terms(p)], np.int32)
            if len(f):
                rows.append(f)
                own.append(d)
    if not rows or not k:
        return {}, set()
    size = np.array([len(f) for f in rows])
    row, col, start = np.repeat(np.arange(len(rows)), size), np.concatenate(rows), np.concatenate([[0], np.cumsum(size)[:-1]])
    n, v = len(rows), len(voc)
    about = np.zeros((len(texts), k), bool)
    for d, s in enumerate(labels):
        for x in s:
            if x in at:
                about[d, at[x]] = True
    Y = about[own]
    q = Y / np.maximum(Y.sum(1, keepdims=True), 1)
    base = np.maximum(q.mean(0), 1e-4)
    count = np.bincount(col, minlength=v)
    phrase = np.array([" " in x or _CJK.match(x) is not None and len(x) > 1 for x in voc])  # a single word marks no passing mention
    for turn in range(rounds):
        share = (np.stack([np.bincount(col, weights=q[row, c], minlength=v) for c in range(k)], 1) + SMOOTH * base) / (count + SMOOTH)[:, None]
        W = np.log(share / base)
        W = np.where(share >= np.maximum(SHARE, 1.5 * base), W, 0) if turn else np.where(W > LIFT * -np.log(base), W, 0)
        score = np.stack([np.add.reduceat(W[col, c], start) for c in range(k)], 1)
        best = score.argmax(1)
        hit = score.max(1) > SCORE
        right = hit & Y[np.arange(n), best]
        hits, rights = np.bincount(col, weights=hit[row], minlength=v), np.bincount(col, weights=right[row], minlength=v)
        passing = ((rights + 1.8) / (hits + 2) < 0.5) & (hits >= 4) & (W.max(1) <= 0) & phrase
        use = np.flatnonzero(right)
        z = np.where(Y[use], score[use], -np.inf)
        top = z.max(1, keepdims=True)
        e = np.where(top > 0, np.exp(z - np.maximum(top, 0)), 0)
        q = np.zeros((n, k))
        q[use] = e / np.maximum(e.sum(1, keepdims=True), 1e-300)
        base = np.maximum(q.mean(0), 1e-4)
    keep = W.any(1)
    return {x: W[i].astype(np.float32) for x, i in voc.items() if keep[i]}, {x for x, i in voc.items() if passing[i]}


class Latent:
    """Latent vectors of terms from the documents they occur in: a randomised singular value decomposition of the term-document matrix."""

    def __init__(self, documents: list[Counter], dimensions: int = DIMENSIONS, seed: int = 1, turns: int = 3):
        self.at: dict[str, int] = {}
        row = np.array([self.at.setdefault(t, len(self.at)) for d in documents for t in d], np.int64)
        size = [len(d) for d in documents]
        col = np.repeat(np.arange(len(documents)), size)
        v, n = len(self.at), len(documents)
        value = np.array([1 + np.log(x) for d in documents for x in d.values()], np.float32)
        self.idf = np.log1p(n / np.maximum(np.bincount(row, minlength=v), 1)).astype(np.float32)
        value = value * self.idf[row]
        value /= np.sqrt(np.bincount(col, weights=value**2, minlength=n))[col].astype(np.float32)
        by_row = np.argsort(row, kind="stable")
        full = np.flatnonzero(size)

        def summed(order: np.ndarray, starts: np.ndarray, pick: np.ndarray, q: np.ndarray, rows: int, at: np.ndarray) -> np.ndarray:
            """Sums of the runs that begin at ``starts`` of the weighted rows ``pick`` of ``q``, some 50,000 at a time."""
            out = np.zeros((rows, q.shape[1]), np.float32)
            ends = np.append(starts[1:], len(order))
            i = 0
            while i < len(starts):
                j = max(int(np.searchsorted(ends, starts[i] + 50_000, "right")), i + 1)
                part = order[starts[i] : ends[j - 1]]
                out[at[i:j]] = np.add.reduceat(value[part, None] * q[pick[part]], starts[i:j] - starts[i], axis=0)
                i = j
            return out

        row_starts, col_starts = np.flatnonzero(np.diff(row[by_row], prepend=-1)), np.concatenate([[0], np.cumsum(size)])[full].astype(np.int64)
        times = lambda q: summed(by_row, row_starts, col, q, v, np.arange(v))  # noqa: E731  terms by documents
        transposed = lambda q: summed(np.arange(len(row)), col_starts, row, q, n, full)

        k = min(dimensions + 10, v, n)
        q = np.linalg.qr(times(np.random.default_rng(seed).normal(size=(n, k)).astype(np.float32)))[0]
        for _ in range(turns):
            q = np.linalg.qr(times(transposed(q)))[0]
        u = np.linalg.svd(transposed(q).T, full_matrices=False)[0]
        e = (q @ u)[:, :dimensions]
        self.terms = (e / np.maximum(np.linalg.norm(e, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    @classmethod
    def of(cls, at: dict[str, int], idf: np.ndarray, terms_: np.ndarray) -> Latent:
        out = cls.__new__(cls)
        out.at, out.idf, out.terms = at, idf, terms_
        return out

    def vector(self, terms_: list[str]) -> np.ndarray | None:
        """The normalised vector of a passage's terms; None if none is known."""
        at = [self.at[t] for t in terms_ if t in self.at]
        if not at:
            return None
        v = self.idf[at] @ self.terms[at]
        size = np.linalg.norm(v)
        return v / size if size > 1e-9 else None


def bisect(x: np.ndarray, weight: np.ndarray, leaves: int = LEAVES, seed: int = 7, trials: int = 2, turns: int = 15) -> np.ndarray:
    """The leaf of each row of ``x``: the leaf with the largest squared spread is split in two by k-means until there are ``leaves``."""
    rng = np.random.default_rng(seed)
    leaf = np.zeros(len(x), np.int64)

    def spread(rows: np.ndarray) -> float:
        centre = weight[rows] @ x[rows] / weight[rows].sum()
        return float(weight[rows] @ ((x[rows] - centre) ** 2).sum(1))

    cost = {0: spread(np.arange(len(x)))} if len(x) else {}
    while cost and len(cost) < leaves:
        worst = max(cost, key=cost.get)
        if cost[worst] <= 1e-9:
            break
        rows = np.flatnonzero(leaf == worst)
        y, w = x[rows], weight[rows]
        best: tuple[float, np.ndarray] | None = None
        for _ in range(trials):
            one = y[rng.integers(len(rows))]
            far = w * ((y - one) ** 2).sum(1)
            c = np.stack([one, y[rng.choice(len(rows), p=far / far.sum())] if far.sum() > 0 else one])
            for _ in range(turns):
                d = (c**2).sum(1) - 2 * y @ c.T
                side = d.argmin(1)
                if not 0 < side.sum() < len(side):
                    break
                c = np.stack([w[side == j] @ y[side == j] / w[side == j].sum() for j in (0, 1)])
            total = float(w @ d.min(1))
            if best is None or total < best[0]:
                best = total, side
        if not 0 < best[1].sum() < len(rows):
            cost[worst] = 0.0
            continue
        leaf[rows[best[1] == 1]] = len(cost)
        cost[worst], cost[len(cost)] = spread(rows[best[1] == 0]), spread(rows[best[1] == 1])
    return leaf


def mixtures(cells: dict[tuple[frozenset, int], float], leaves: int, subjects: list[int], rounds: int = 10) -> np.ndarray:
    """Each leaf's mixture of ``subjects`` from the passages that documents with the same label set have in it.

    A passage belongs to one of its document's labels, or to none; which, the other passages of its leaf tell.
    """
    at = {s: i for i, s in enumerate(subjects)}
    keys = list(cells)
    may = np.zeros((len(keys), len(subjects)))
    for i, (labels, _) in enumerate(keys):
        may[i, [at[s] for s in labels if s in at]] = 1
    leaf, n = np.array([k[1] for k in keys], np.int64), np.array([cells[k] for k in keys], float)
    all_ = np.bincount(leaf, weights=n, minlength=leaves)
    mix = np.full((leaves, len(subjects)), 1 / max(len(subjects), 1))
    for _ in range(rounds):
        r = may * mix[leaf]
        r *= (n / np.maximum(r.sum(1), 1e-12))[:, None]
        mix = np.stack([np.bincount(leaf, weights=r[:, c], minlength=leaves) for c in range(len(subjects))], 1)
        mix = (mix + 0.01) / (all_[:, None] + 0.2)
    return mix


@dataclass
class Tree:
    """A fitted classifier; empty if no labelled text says anything."""

    subjects: list[int]
    weights: dict[str, np.ndarray]
    passing: set[str]
    latent: Latent | None = None
    centres: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    mixture: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    labels: list[int] = field(default_factory=list)
    terms: list[list[str]] = field(default_factory=list)

    @cached_property
    def sizes(self) -> np.ndarray:
        return (self.centres**2).sum(1)

    @property
    def empty(self) -> bool:
        return self.latent is None

    def plain(self) -> tuple:
        """What workers need, in types that they know without this package (broadcast values are pickled by name)."""
        return self.weights, self.passing, self.latent.at, self.latent.idf, self.latent.terms, self.centres

    @classmethod
    def of(cls, weights: dict, passing: set, at: dict, idf: np.ndarray, terms_: np.ndarray, centres: np.ndarray) -> Tree:
        return cls([], weights, passing, Latent.of(at, idf, terms_), centres)

    def known_terms(self, passage: str) -> list[str]:
        """The discriminative terms of a passage; none if together they say too little, or if it is a passing mention."""
        found = terms(passage)
        known = sorted(t for t in found if t in self.weights)
        if not known or len(found & self.passing) >= MARKS or np.sum([self.weights[t] for t in known], axis=0).max() <= SCORE:
            return []
        return known

    def leaf(self, v: np.ndarray) -> int:
        return int((self.sizes - 2 * self.centres @ v).argmin())


def fit(texts: list[str | None], labels: list[set[int]], subjects: list[int], leaves: int = LEAVES) -> Tree:
    """Terms, latent space, tree and leaf mixtures of labelled documents."""
    tree = Tree(subjects, *fit_terms(texts, labels, subjects))
    own: list[list[tuple[str, ...]]] = []
    known: dict[str, tuple[str, ...]] = {}
    for t in texts:
        at = passages(t)
        for p in at:
            if p not in known:
                known[p] = tuple(tree.known_terms(p))
        own.append([f for p in at if (f := known[p])])
    if not any(own):
        return tree
    latent = Latent([Counter(t for f in d for t in f) for d in own])
    count = Counter(f for d in own for f in d)
    vectors = {f: v for f in count if (v := latent.vector(list(f))) is not None}
    keys = list(vectors)
    x, w = np.stack([vectors[f] for f in keys]), np.array([count[f] for f in keys], np.float32)
    leaf = bisect(x, w, leaves)
    n = int(leaf.max()) + 1
    tree.latent = latent
    tree.centres = np.stack([w[leaf == j] @ x[leaf == j] / w[leaf == j].sum() for j in range(n)]).astype(np.float32)
    nearest = {f: tree.leaf(v) for f, v in vectors.items()}
    cells = Counter((frozenset(s for s in l if s is not None), nearest[f]) for d, l in zip(own, labels) for f in d if f in nearest)
    tree.mixture = mixtures(cells, n, subjects)
    names = list(latent.at)
    for c, m in zip(tree.centres, tree.mixture):
        close = latent.terms @ (c / max(np.linalg.norm(c), 1e-9)) * np.sqrt(latent.idf)
        tree.terms.append([names[i] for i in np.argsort(-close, kind="stable")[:8]])
        tree.labels.append(subjects[int(m.argmax())])
    return tree


def learn(documents: DataFrame, labels: DataFrame, subjects: list[int], max_labelled: int = MAX_LABELLED, max_chars: int = MAX_CHARS, leaves: int = LEAVES) -> Tree:
    """A classifier from at most ``max_labelled`` labelled documents of ``max_chars`` characters; a null subject means that none applies.

    Documents are taken by hash, as far as both bounds go; a text is taken whole or not at all.
    """
    lab = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.collect_set("subject_id").alias("about"))
    chosen = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    # at most max_labelled rows are ordered in one task, without their texts
    sizes = rows.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("size")).withColumn("upto", F.sum("size").over(Window.partitionBy().orderBy(F.xxhash64("doc_id"), "doc_id")))
    rows = rows.join(F.broadcast(sizes.filter(F.col("upto") <= max_chars).select("doc_id")), "doc_id").orderBy("doc_id").collect()
    return fit([r["text"] for r in rows], [set(r["about"]) for r in rows], subjects, leaves)


def _descender(shared, id_at: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree.of(*shared.value)
        known: dict[str, int | None] = {}

        def leaf(p: str) -> int | None:
            if p not in known:
                if len(known) > 200_000:
                    known.clear()
                found = tree.known_terms(p)
                v = tree.latent.vector(found) if found else None
                known[p] = None if v is None else tree.leaf(v)
            return known[p]

        for b in batches:
            ids, leaves, n = [], [], []
            for d, raw in zip(b.column(id_at).to_pylist(), b.column(text_at).cast(pa.large_binary()).to_pylist()):
                at = Counter(leaf(p) for p in passages(None if raw is None else raw.decode("utf-8", "replace")))
                at.pop(None, None)
                ids += [d] * len(at)
                leaves += at.keys()
                n += at.values()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(leaves, pa.int32()), pa.array(n, pa.int64())], ["doc_id", "leaf", "n"])

    return run


def document_leaves(documents: DataFrame, tree: Tree) -> DataFrame:
    """``doc_id, leaf, n``: how many passages of each row's text fall into each leaf."""
    docs = documents.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(tree.plain())
    return docs.mapInArrow(_descender(shared, 0, 1), "doc_id long, leaf int, n long")


def leaf_mixtures(documents: DataFrame, tree: Tree, least: float = 0.0) -> DataFrame:
    """``leaf, subject_id, share``, for shares of at least ``least``: at most the leaves times the subjects."""
    rows = [(i, int(s), float(x)) for i, m in enumerate(tree.mixture) for s, x in zip(tree.subjects, m) if x >= least]
    return documents.sparkSession.createDataFrame(rows, "leaf int, subject_id long, share double")


def classify(documents: DataFrame, labels: DataFrame, subjects: DataFrame, passages_needed: int = PASSAGES, **bounds: int) -> tuple[DataFrame, Tree]:
    """``doc_id, subject_id, n_passages`` of all documents, and the tree. Documents without a subject have no row.

    Null and blank texts have no subjects; without labels or texts the result is empty. A repeated ``doc_id`` is one document with the passages of all its rows. More
    than ``SUBJECTS`` subjects are an error.
    """
    ids = sorted(r["subject_id"] for r in subjects.filter("subject_id is not null").select("subject_id").distinct().limit(SUBJECTS + 1).collect())
    if len(ids) > SUBJECTS:
        raise ValueError(f"more than {SUBJECTS} subjects")
    tree = learn(documents, labels, ids, **bounds)
    if tree.empty:
        return documents.sparkSession.createDataFrame([], "doc_id long, subject_id long, n_passages long"), tree
    j = document_leaves(documents, tree).join(F.broadcast(leaf_mixtures(documents, tree, PART)), "leaf")
    found = j.groupBy("doc_id", "subject_id").agg(F.sum("n").alias("n_passages"))
    return found.filter(F.col("n_passages") >= passages_needed), tree
