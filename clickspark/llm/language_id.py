"""Language identification with a string kernel."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.sampling import bounded_sample, remainder
from clickspark.llm.storage import Sent
from clickspark.sources.shared import materialize

UNKNOWN = "und"
#: Letters are told apart up to this many; 0 stands for what is between words.
ALPHABET = 64
GRAMS = 3
_BATCH = 128


@dataclass(frozen=True)
class Model:
    """``letters`` maps code points to 0..63, ``seen`` says which the sample has.
    ``column`` numbers the n-grams of the landmarks (-1: none has it),
    ``weights`` has a row for each of them and a column per language. Its size
    is bounded by the landmarks'."""

    languages: list[str]
    letters: np.ndarray
    seen: np.ndarray
    column: np.ndarray
    weights: np.ndarray


class Grams:
    """Which n-grams of 1 to 3 letters a text has: the features of the blended
    spectrum presence kernel."""

    size = sum(ALPHABET**p for p in range(1, GRAMS + 1))

    def __init__(self, letters: np.ndarray):
        self.letters = letters
        self.seen = np.zeros(self.size, np.int32)

    def of(self, text: str) -> np.ndarray:
        """The different n-grams of a whole text, in no special order."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self.letters[points].astype(np.int32)
        keep = found > 0
        keep[1:] |= found[:-1] > 0
        found = found[keep]
        grams, base, code = [found], 0, found
        for p in range(2, GRAMS + 1):
            base += ALPHABET ** (p - 1)
            code = code[:-1] * ALPHABET + found[p - 1 :] if len(code) > 0 else code
            grams.append(code + base)
        every = np.concatenate(grams)
        places = np.arange(len(every), dtype=np.int32)
        self.seen[every] = places  # the last of equal ones stays
        return every[self.seen[every] == places]


def _alphabet(texts: list[str]) -> np.ndarray:
    """The commonest letters of the sample get numbers, other letters the last."""
    counts = Counter(c for text in texts for c in text.lower() if c.isalpha())
    letters = np.zeros(0x110000, np.uint8)
    common = sorted(counts, key=lambda c: (-counts[c], c))[: ALPHABET - 2]
    others = [c for c in range(0x110000) if chr(c).isalpha()]
    letters[others] = ALPHABET - 1
    for number, char in enumerate(common, 1):
        letters[ord(char)] = number
    return letters


def fit_sample(texts: list[str], labels: list[str], landmarks: int, ridge: float) -> Model:
    """Kernel ridge regression, one language against the rest, on a sample in
    random order.

    ``k(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|)`` for the sets of n-grams.
    Nyström features come from ``landmarks`` texts, as many of each language as
    can be; the regression weighs languages alike. As the kernel is a matrix
    product of presences, landmarks and coefficients fold into one weight per
    n-gram and language.
    """
    languages = sorted(set(labels))
    letters = _alphabet(texts)
    spelt = np.zeros(len(letters), bool)
    spelt[[ord(c) for c in set().union(*(t.lower() for t in texts))]] = True
    grams = Grams(letters)
    found = [grams.of(t) for t in texts]
    seen: Counter = Counter()
    chosen = []
    for i, label in enumerate(labels):
        seen[label] += 1
        if seen[label] <= max(1, landmarks // len(languages)) and len(found[i]):
            chosen.append(i)
    used = np.unique(np.concatenate([found[i] for i in chosen])) if chosen else np.zeros(0, int)
    column = np.full(Grams.size, -1, np.int32)
    column[used] = np.arange(len(used), dtype=np.int32)
    if not chosen:
        return Model([], letters, spelt, column, np.zeros((0, 0), np.float32))

    def presence(rows: list[int]) -> np.ndarray:
        matrix = np.zeros((len(rows), len(used)), np.float32)
        for k, i in enumerate(rows):
            at = column[found[i]]
            matrix[k, at[at >= 0]] = 1 / np.sqrt(len(found[i]))
        return matrix

    marks = presence(chosen)
    similar = np.concatenate(
        [presence(list(range(k, min(k + _BATCH, len(texts))))) @ marks.T for k in range(0, len(texts), _BATCH)]
    ).astype(np.float64)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > values.max() * 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    features = similar @ root
    targets = np.where(np.array(labels)[:, None] == np.array(languages)[None], 1.0, -1.0)
    each = Counter(labels)
    share = np.array([1 / each[x] for x in labels])[:, None]
    bent = features.T @ (share * features) + ridge * np.eye(features.shape[1])
    inner = np.linalg.solve(bent, features.T @ (share * targets))
    return Model(languages, letters, spelt, column, (marks.T @ (root @ inner)).astype(np.float32))


def _sample(docs, text, lang, doc_id, sample_rows, most_languages, most_chars):
    known = docs.where(
        F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & F.length(text).between(1, most_chars)
    ).select(
        F.col(doc_id).alias("doc_id"),
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    n = known.select("lang").distinct().limit(most_languages).count()
    sample = bounded_sample(known, "lang", "doc_id", sample_rows // max(1, n), most_languages)
    return sorted(sample.select("order", "doc_id", "lang", "text").collect())


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    sample_rows: int = 2048,
    most_languages: int = 64,
    most_chars: int = 20_000,
    landmarks: int = 256,
    ridge: float = 0.01,
) -> Model:
    """A model from ``docs`` whose language is not null.

    It is fitted to a sample of ``sample_rows`` rows at most, as many of each
    language (of the ``most_languages`` commonest), of whole texts of up to
    ``most_chars`` characters. The sample goes to the driver.
    """
    rows = _sample(docs, text, lang, doc_id, sample_rows, most_languages, most_chars)
    return fit_sample([r["text"] for r in rows], [r["lang"] for r in rows], landmarks, ridge)


def scores(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: half of one plus the regression's value,
    within 0 and 1. ``und`` and 0 for null texts and those without a letter."""
    grams = Grams(model.letters)
    langs, values = [], np.zeros(len(texts))
    for at in range(0, len(texts), _BATCH):
        part = texts[at : at + _BATCH]
        known = [t is not None and any(map(str.isalpha, t)) for t in part]
        matrix = np.zeros((len(part), len(model.weights)), np.float32)
        norms = np.ones(len(part))
        for i, text in enumerate(part):
            if known[i]:
                found = grams.of(text)
                columns = model.column[found]
                matrix[i, columns[columns >= 0]] = 1
                norms[i] = np.sqrt(max(1, len(found)))
        if not model.languages:
            langs += [UNKNOWN] * len(part)
            continue
        values_here = (matrix @ model.weights) / norms[:, None]
        best = values_here.argmax(axis=1)
        langs += [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        top = np.clip((1 + values_here[np.arange(len(part)), best]) / 2, 0, 1)
        values[at : at + _BATCH] = np.where(known, top, 0)
    return langs, values


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of whole texts; repeated rows
    each get theirs. Columns of these names are replaced. A model of an empty
    table says ``und``. The model is broadcast: it is as large as its landmarks
    (64 languages, 256 texts of 20,000 characters: a few MB)."""
    sent = Sent(docs.sparkSession, model)
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = others.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, values = scores(sent.value, batch.column(at).cast(pa.large_string()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(values)],
                [*others, "lang_pred", "score"],
            )

    kept = docs.select(*(F.col(f"`{c}`") for c in others))
    schema = T.StructType([*kept.schema.fields]).add("lang_pred", "string").add("score", "double")
    return kept.mapInArrow(run, schema)


def strangeness(model: Model, texts: list[str | None]) -> np.ndarray:
    """How foreign each text is to the model: the share of its different n-grams
    that no landmark has, or of its letters that the sample does not have if
    that is more. Of a share the lower end of its Wilson interval (3 standard
    deviations) is given, so that few n-grams prove little. 1 for null texts,
    those without a letter, and all texts if the model is empty."""
    grams = Grams(model.letters)
    found = np.ones(len(texts))
    for i, text in enumerate(texts):
        if model.languages and text is not None and any(map(str.isalpha, text)):
            every = grams.of(text)
            points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            points = points[model.letters[points] > 0]
            new = _at_least((model.column[every] < 0).sum(), len(every))
            found[i] = max(new, _at_least((~model.seen[points]).sum(), len(points)))
    return found


def _at_least(count: int, n: int, z: float = 3.0) -> float:
    if n == 0:
        return 0.0
    share, extra = count / n, z * z / n
    spread = z * np.sqrt(share * (1 - share) / n + extra / n / 4)
    return max(0.0, (share + extra / 2 - spread) / (1 + extra))


def fit_limit(
    model: Model,
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    share: float = 0.999,
    margin: float = 0.1,
) -> float:
    """The strangeness above which a text is in none of the model's languages:
    ``margin`` more than ``share`` of all ``docs`` of these languages have, which are to
    be rows that the model was not fitted to. Whole texts of any length count; rows
    without an id, a text or a letter do not. Only two values go to the driver."""
    sent = Sent(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in batch.column(0).cast(pa.large_string()).to_pylist() if any(map(str.isalpha, t))]
            yield pa.RecordBatch.from_arrays([pa.array(strangeness(sent.value, texts))], ["strange"])

    known = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
    known = known.where(F.col(lang).cast("string").isin(model.languages))
    told = known.select(F.col(text).cast("string")).mapInArrow(run, "strange double")
    found = materialize(told, "strangeness")
    # The quantile lies between the two lowest of the largest values.
    at = share * max(0, (n := found.count()) - 1)
    largest = found.orderBy(F.desc("strange")).limit(n - int(at))
    ends = [r["strange"] for r in largest.orderBy("strange").limit(2).collect()] or [0.0]
    most = ends[0] + (ends[-1] - ends[0]) * (at - int(at))
    return min(most + margin, 0.99)  # texts without a letter are never in a language


def in_language(model: Model, texts: list[str | None], limit: float) -> np.ndarray:
    """Whether each text is in one of the model's languages: the regression names one
    (``scores``), and the text is no stranger to the model than ``limit``."""
    langs, _ = scores(model, texts)
    named = np.array([lang != UNKNOWN for lang in langs], dtype=bool)
    return named & (strangeness(model, texts) <= limit)


def in_languages(docs: DataFrame, model: Model, limit: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in one of the model's languages (``in_language``)."""
    sent = Sent(docs.sparkSession, model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_string()).to_pylist()
            yield batch.filter(pa.array(in_language(sent.value, texts, limit)))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Rows that a model is tested on, not fitted to."""
    return F.coalesce(remainder(doc_id, 4) == 2, F.lit(False))
