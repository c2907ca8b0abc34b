"""Language identification in two steps: the family, then languages within it.

A text is the mean of the weights of its byte trigrams and 4-grams (letters
lower-cased, everything but letters one space). One-versus-rest linear support
vector machines choose the language family; within it, a machine for every
pair of languages votes (one-versus-one).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import joined, row_blocks, texts_of, tidied
from quarry.llm.samples import per_class

DIM = 1 << 14            # half for trigrams, half for 4-grams
SAMPLE_PER_LANGUAGE = 300
UNKNOWN = "und"

#: Language codes by family; a code not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky tt",
    "indo-aryan": "hi bn mr gu pa ur ne si",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "malayic": "id ms jv su",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def gram_bins(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the trigram and the 4-gram starting at every byte (the last three wrap into zeros)."""
    b = np.concatenate([letters, np.full(3, 32, np.uint8)]).astype(np.uint32)
    n = len(letters)
    three = b[:n] << 16 | b[1:n + 1] << 8 | b[2:n + 2]
    four = three << 8 | b[3:n + 3]
    shift = np.uint32(32 - (DIM // 2).bit_length() + 1)
    return three * np.uint32(0x9E3779B1) >> shift, (four * np.uint32(0x85EBCA77) >> shift) + np.uint32(DIM // 2)


def letters_of(texts: list[bytes], sep: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    raw, off = joined([t.decode().lower().encode() for t in texts], sep)
    return _LETTER[raw], off


class Sparse:
    """Rows of few non-zero entries: bins, values and the ends of the rows."""

    def __init__(self, bins: np.ndarray, values: np.ndarray, ends: np.ndarray):
        self.bins, self.values, self.ends = bins, values, ends
        self.row = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))

    def __len__(self) -> int:
        return len(self.ends)

    def take(self, keep: np.ndarray) -> Sparse:
        """The rows where ``keep`` is true."""
        own = keep[self.row]
        return Sparse(self.bins[own], self.values[own], np.cumsum(np.diff(np.concatenate([[0], self.ends]))[keep]))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.bins], minlength=len(self))

    def dot_rows(self, v: np.ndarray) -> np.ndarray:
        """The transposed product: a sum per bin."""
        return np.bincount(self.bins, self.values * v[self.row], minlength=DIM)


def frequencies(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bins that a text has and their relative frequencies, for fitting."""
    letters, _ = letters_of([text])
    bins, n = np.unique(np.concatenate(gram_bins(letters)), return_counts=True)
    return bins.astype(np.uint16), (n / len(letters)).astype(np.float32)


def linear_svm(x: Sparse, y: np.ndarray, l2: float = 1e-3, rounds: int = 120) -> np.ndarray:
    """Weights (last: bias) of an L2-regularized squared-hinge machine, classes weighted alike.

    y is +1 or -1. Nesterov steps on the full (bounded) sample.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    squares = np.bincount(x.row, x.values.astype(np.float64) ** 2, minlength=len(x)) + 1
    step = 1.0 / (2 * float((weight * squares).sum()) + l2)
    w = z = np.zeros(DIM + 1)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x.dot(z[:-1]) + z[-1]))
        push = weight * slack * y
        nxt = z - step * (l2 * z - 2 * np.append(x.dot_rows(push), push.sum()))
        z = nxt + k / (k + 3) * (nxt - w)
        w = nxt
    return w


class Model:
    """Bin weights of all machines side by side, and who they belong to."""

    def __init__(self, langs: list[str], x: Sparse, y: np.ndarray):
        self.langs = langs
        self.families = sorted({family_of(c) for c in langs})
        scale = 1 / np.sqrt(np.bincount(x.bins, x.values, minlength=DIM) / max(1, len(x)) + 1e-7)
        x = Sparse(x.bins, x.values * scale[x.bins], x.ends)
        fam = np.array([self.families.index(family_of(langs[i])) for i in y], int)
        machines = [(x, np.where(fam == f, 1, -1)) for f in range(len(self.families))] if len(self.families) > 1 else []
        self.pairs = []
        for f, name in enumerate(self.families):
            for a, b in combinations([i for i, c in enumerate(langs) if family_of(c) == name], 2):
                rows = (y == a) | (y == b)
                machines.append((x.take(rows), np.where(y[rows] == a, 1, -1)))
                self.pairs.append((f, a, b))
        fitted = [linear_svm(m, s) for m, s in machines]
        self.weights = np.ascontiguousarray(np.array([w[:-1] * scale for w in fitted], np.float32).reshape(-1, DIM).T)
        self.bias = np.array([w[-1] for w in fitted], np.float64)

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Decision values (texts x machines): bias plus the mean weight over a text's grams, whatever texts are beside it."""
        letters, off = letters_of(texts, b"    ")
        beyond = (off[1:, None] - np.arange(1, 4)).ravel()   # grams that begin behind the first blank
        out = np.zeros((len(texts), len(self.bias)))
        three, four = gram_bins(letters)
        for m in range(len(self.bias)):
            w = self.weights[:, m]
            own = (w[three] + w[four]).astype(np.float64)
            own[beyond] = 0.0
            out[:, m] = np.add.reduceat(own, off[:-1]) / (np.diff(off) - 3) + self.bias[m]
        return out

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """Language and score of each text, whether it has a letter or not."""
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        margins = self.margins(texts)
        n_fam = len(self.families) if len(self.families) > 1 else 0
        fam_p = _softmax(3 * margins[:, :n_fam]) if n_fam else np.ones((len(texts), 1))
        fam = fam_p.argmax(1)
        votes = np.full((len(texts), len(self.langs)), -1.0)
        belongs = np.array([self.families.index(family_of(c)) for c in self.langs])
        votes[belongs[None, :] == fam[:, None]] = 0
        for k, (f, a, b) in enumerate(self.pairs):
            rows = fam == f
            p = 1 / (1 + np.exp(-np.clip(6 * margins[rows, n_fam + k], -50, 50)))
            votes[rows, a] += (p >= 0.5) + 1e-3 * p      # a vote each; probabilities part ties
            votes[rows, b] += (p < 0.5) + 1e-3 * (1 - p)
        best = votes.argmax(1)
        score = fam_p[np.arange(len(texts)), fam]
        for k, (_f, a, b) in enumerate(self.pairs):   # times the chosen language's weakest pair
            p = 1 / (1 + np.exp(-np.clip(6 * margins[:, n_fam + k], -50, 50)))
            score = np.where(best == a, score * np.maximum(p, 0.5), np.where(best == b, score * np.maximum(1 - p, 0.5), score))
        return [self.langs[i] for i in best], np.clip(score, 0, 1).tolist()


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        bound: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on at most ``bound`` labelled rows of each language (rows with null text or language are left out).

    The sampled texts' non-zero bin frequencies are computed in tasks and
    collected: ``bound`` x languages x 6 bytes a bin that occurs, at most
    98 KB a text and some 10 KB for a page of text.
    """
    rows = labelled.where(F.col(text_col).isNotNull())
    chosen = per_class(rows, id_col, lang_col, bound)
    src = (rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
           .join(F.broadcast(chosen), "id").select("id", "text", "class"))   # bound x languages ids

    def run(batches):
        for b in batches:
            texts = texts_of(b, "text")
            for k in range(0, len(texts), 50):
                x = [frequencies(t) for t in texts[k:k + 50]]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(k, 50).cast(pa.int64()), b.column("class").slice(k, 50),
                     *(pa.array([part[i].tobytes() for part in x], pa.binary()) for i in (0, 1))], ["id", "lang", "bins", "x"])

    got = sorted(src.mapInArrow(tidied(run), "id bigint, lang string, bins binary, x binary").collect())
    langs = sorted({r.lang for r in got})
    bins = np.frombuffer(b"".join(r.bins for r in got), np.uint16)
    values = np.frombuffer(b"".join(r.x for r in got), np.float32)
    return Model(langs, Sparse(bins, values, np.cumsum([len(r.bins) // 2 for r in got], dtype=np.int64)),
                 np.array([langs.index(r.lang) for r in got], int))


def has_letter(text: bytes) -> bool:
    """Whether any character is a letter in Unicode's sense."""
    if text.translate(None, _NO_ASCII_LETTER) != b"":
        return True
    return any(ch.isalpha() for ch in text.decode()) if not text.isascii() else False


_NO_ASCII_LETTER = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred string, score double in 0..1) for every input row.

    Only the text is read, whole. ``und`` with score 0 where the text is null
    or has no letter, or where nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)   # DIM x machines floats
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            texts = texts_of(b, "text")
            for part in row_blocks(texts):
                own = texts[part]
                lang, score = shared.value.predict(own)
                known = [has_letter(t) for t in own]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(part.start, len(own)),
                     pa.array([x if k else UNKNOWN for x, k in zip(lang, known, strict=True)], pa.string()),
                     pa.array([float(s) if k else 0.0 for s, k in zip(score, known, strict=True)], pa.float64())],
                    ["id", "lang_pred", "score"])

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(tidied(run), f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)
