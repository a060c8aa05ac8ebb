"""Top-k documents per seed with per-term score bounds: only documents that can enter the k best are scored.

A seed is a short list of weighted terms, a document a bag of terms; the score is the sum of weight x occurrences over shared
terms.  The occurrences of a term are at most its largest count, so each term adds at most a known amount.  The head of every
term's postings, by falling count, gives k documents with a score that the k best must reach.  Terms that together cannot
reach it are not essential: a document that has no other term of the seed is never scored for it.

Documents are scored where they lie, a block of seeds at a time; a task hands on its k best per seed.  So no (seed, document)
table is shuffled, and what is sent to the tasks has the size of a block of seeds.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Most (document, seed) cells and most documents that a task scores at once.
CELLS = 1_000_000
DOCUMENTS = 512
#: Bounds are raised by this share, more than sums are rounded.
SLACK = 1e-9
FOUND = "seed int, doc_id long, score double, scored long"


def count_terms(vocabulary):
    """Rows (doc_id, tokens) -> (doc_id, terms, counts): ascending term numbers (places in ``vocabulary``) and occurrences.

    Documents without a term of the vocabulary are left out.
    """

    def run(arrow):
        known = pa.array(vocabulary.value, pa.string())
        for batch in arrow:
            tokens = batch.column("tokens")
            sizes = np.diff(tokens.offsets.to_numpy())
            found = pc.index_in(tokens.flatten(), value_set=known).fill_null(-1).to_numpy()
            own = np.repeat(np.arange(len(sizes)), sizes)[found >= 0]
            pair, times = np.unique(own.astype(np.int64) * max(1, len(known)) + found[found >= 0], return_counts=True)
            doc = pair // max(1, len(known))
            starts = np.flatnonzero(np.diff(doc, prepend=-1))
            offsets = pa.array(np.append(starts, len(pair)), pa.int32())
            lists = (pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (pair % max(1, len(known)), times))
            keys = batch.column("doc_id").take(pa.array(doc[starts]))
            yield pa.RecordBatch.from_arrays([keys, *lists], names=["doc_id", "terms", "counts"])

    return run


class SeedIndex:
    """Seeds by term, with what is essential."""

    def __init__(self, entries, reach, most, terms, seeds):
        """entries: (seed, term, weight) rows; reach: seed -> score that its k best reach; most: term -> largest count."""
        rows = np.array(sorted((t, s, w) for s, t, w in entries), float).reshape(-1, 3)
        self.term, self.seed, self.weight = rows[:, 0].astype(np.int64), rows[:, 1].astype(np.int64), rows[:, 2]
        self.seeds = seeds
        self.starts = np.searchsorted(self.term, np.arange(terms + 1))
        bound = self.weight * np.array([most.get(t, 0) for t in self.term.tolist()], float)
        # Terms of a seed by rising bound: the first ones whose sum stays below the reach are not essential.
        order = np.lexsort((self.term, bound, self.seed))
        sums = np.cumsum(bound[order])
        firsts = np.searchsorted(self.seed[order], self.seed[order])
        within = sums - np.where(firsts > 0, sums[firsts - 1], 0.0)
        needed = np.array([reach.get(s, 0.0) for s in self.seed[order].tolist()])
        self.essential = np.zeros(len(self.seed), bool)
        self.essential[order] = within * (1 + SLACK) + SLACK >= needed

    def scores(self, doc, term, count, docs):
        """Scores (docs x seeds) of the cells that may enter, and which cells these are."""
        meets = self.starts[term + 1] - self.starts[term]
        entry = np.repeat(np.arange(len(term)), meets)
        post = np.arange(len(entry)) - np.repeat(np.cumsum(meets) - meets - self.starts[term], meets)
        cell = doc[entry] * self.seeds + self.seed[post]
        wanted = np.zeros(docs * self.seeds, bool)
        wanted[cell[self.essential[post]]] = True
        own = wanted[cell]
        entry, post, cell = entry[own], post[own], cell[own]
        total = np.bincount(cell, self.weight[post] * count[entry], docs * self.seeds)
        return total.reshape(docs, self.seeds), wanted.reshape(docs, self.seeds)


def best_of_task(sent, k, digits):
    """Bags (doc_id, terms, counts) -> the k best (seed, doc_id, score) of the task, and how many documents it scored."""

    def run(arrow):
        index = sent.value
        seed, name, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        scored = np.zeros(index.seeds, np.int64)
        step = max(1, min(DOCUMENTS, CELLS // max(1, index.seeds)))
        for batch in arrow:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                terms, counts = part.column("terms"), part.column("counts")
                sizes = np.diff(terms.offsets.to_numpy())
                doc = np.repeat(np.arange(len(sizes)), sizes)
                total, wanted = index.scores(doc, terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy(), len(sizes))
                scored += wanted.sum(axis=0)
                row, column = np.nonzero(wanted)
                names = part.column("doc_id").to_numpy()
                seed, name, score = np.append(seed, column), np.append(name, names[row]), np.append(score, total[row, column])
                order = np.lexsort((name, -np.floor(score * 10.0**digits + 0.5), seed))
                seed, name, score = seed[order], name[order], score[order]
                first = np.arange(len(seed)) - np.searchsorted(seed, seed) < k
                seed, name, score = seed[first], name[first], score[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(seed, pa.int32()), pa.array(name, pa.int64()), pa.array(score), pa.array(scored[seed])],
            names=["seed", "doc_id", "score", "scored"],
        )

    return run
