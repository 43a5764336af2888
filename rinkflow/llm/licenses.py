"""License scans: MinHash bands over overlapping windows find templates, containment confirms them."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rinkflow.llm import words as W
from rinkflow.llm.workers import ship

#: Words per shingle; a shorter template is one shingle.
SHINGLE = 5
#: Ratio of window sizes: a template goes by the next size that holds it.
STEP = 1.25
#: Bands of one row each. A window that holds four fifths of a template has a
#: Jaccard similarity to it of 0.4 or more, so it shares one of BANDS minima
#: but for a chance of 0.6 ** BANDS, less than 1e-5. Windows share shingles with
#: a template hardly by chance, so more rows per band would select no better.
BANDS = 24
#: Templates that a task holds at once; more are scanned in blocks.
BLOCK = 5_000

_FACTORS = W.randoms(BANDS, seed=21) | np.uint64(1)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _shingles(column, size):
    return W.shingle_hashes(*W.word_hashes(column, W.MARKS), size)


def window_size(n_words):
    """The least whole power of STEP that holds so many words."""
    return math.ceil(STEP ** math.ceil(math.log(max(n_words, 1), STEP) - 1e-9))


def _plan(size, shingle):
    """(words between windows, blocks of that many shingles in a window)."""
    stride = max(1, size // 4)
    return stride, -(-(size - shingle + stride) // stride)


class Templates:
    """Templates by (words per shingle, window size), with their sets and minima."""

    def __init__(self, rows):
        """rows: (name, text); those without a name or a word are left out."""
        self.classes = {}
        for name, text in rows:
            hashes, _ = W.word_hashes(pa.array([text], pa.string()), W.MARKS)
            if name is None or not len(hashes):
                continue
            shingle = min(SHINGLE, len(hashes))
            own = np.unique(W.shingle_hashes(hashes, np.array([0, len(hashes)]), shingle)[0])
            self.classes.setdefault((shingle, window_size(len(hashes))), []).append((name, own))
        self.minima = {}
        with np.errstate(over="ignore"):
            for key, templates in self.classes.items():
                self.minima[key] = np.array([[(own * f).min() for _, own in templates] for f in _FACTORS])

    def scan(self, column, percent):
        """(row, name, containment, first word) of the best window of each template in each text."""
        best = {}
        for (shingle, size), templates in self.classes.items():
            hashes, offsets = _shingles(column, shingle)
            if not len(hashes):
                continue
            stride, blocks = _plan(size, shingle)
            counts = -(-np.diff(offsets) // stride)
            row = np.repeat(np.arange(len(counts)), counts)
            first = np.concatenate([[0], np.cumsum(counts)])
            starts = offsets[row] + (np.arange(len(row)) - first[row]) * stride
            for window, t in self._retrieved(hashes, starts, row, blocks, self.minima[shingle, size]):
                name, own = templates[t]
                r = row[window]
                inside = hashes[starts[window] : min(starts[window] + blocks * stride, offsets[r + 1])]
                both = np.isin(own, inside).sum()
                if 100 * both >= percent * len(own):
                    found = (both / len(own), -int(starts[window] - offsets[r]))
                    best[r, name] = max(best.get((r, name), found), found)
        return [(int(r), name, share, -at) for (r, name), (share, at) in best.items()]

    @staticmethod
    def _retrieved(hashes, starts, row, blocks, minima):
        """(window, template) pairs that agree in at least one band."""
        found = set()
        flags = np.zeros(1 << 16, bool)
        for factor, wanted in zip(_FACTORS, minima):
            with np.errstate(over="ignore"):
                one = np.minimum.reduceat(hashes * factor, starts)
            least = one.copy()
            for k in range(1, min(blocks, len(one))):
                nearer = np.where(row[k:] == row[:-k], one[k:], _TOP)
                np.minimum(least[:-k], nearer, out=least[:-k])
            flags[:] = False
            flags[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True
            maybe = np.flatnonzero(flags[(least & np.uint64(0xFFFF)).astype(np.int64)])
            for t, value in enumerate(wanted):
                found.update((int(w), t) for w in maybe[least[maybe] == value])
        return found


def scan_licenses(docs, templates, percent=80, id_column="doc_id", text_column="text"):
    """doc_id, license_id, containment, word: one row per document and template it holds.

    ``templates``: license_id, text. Words are runs of letters, digits and
    non-ASCII bytes, A-Z lower-cased. A document holds a template if some
    window has at least ``percent`` in 100 of the template's distinct shingles;
    the row gives the highest share and the first word of the first such window.

    Defined results: null and empty texts hold nothing; templates with a null
    name or without words are never found; templates with the same name count
    as one, the best match is given; repeated documents give repeated rows;
    null ids stay. Other columns are ignored, empty tables give no rows. Whole
    texts are scanned, in windows that overlap by three quarters.

    Templates are reference data: a task holds BLOCK of them at once, more are
    scanned block by block.
    """
    spark = docs.sparkSession
    ship(spark)
    named = templates.select("license_id", "text").where("license_id is not null and text is not null")
    blocks = max(1, -(-named.count() // BLOCK))
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    parts = []
    for block in range(blocks):
        rows = named.where(F.pmod(F.xxhash64("license_id", "text"), F.lit(blocks)) == block).collect()
        held = spark.sparkContext.broadcast(Templates([tuple(r) for r in rows]))
        parts.append(_scan(texts, held, percent))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _scan(texts, held, percent):
    def run(batches):
        for batch in batches:
            for a, b in W.chunks(batch.column(1), 2 << 20):
                found = held.value.scan(batch.column(1).slice(a, b - a), percent)
                if found:
                    rows, names, shares, at = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(a, b - a).take(pa.array(rows)),
                            pa.array(names, pa.string()),
                            pa.array(shares, pa.float64()),
                            pa.array(at, pa.int64()),
                        ],
                        names=["doc_id", "license_id", "containment", "word"],
                    )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, license_id string, containment double, word long")
