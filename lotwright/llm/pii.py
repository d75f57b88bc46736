"""Personal data: base patterns, and a linear-chain CRF over word shapes that adds spans.

Base spans are the leftmost non-overlapping matches per kind that pass the
kind's check.  The CRF labels the words of each line (BIO over the kinds) from
word-shape features of a word and its neighbours.  It is trained on the driver
from a small labelled table (at most ``MAX_LABELLED`` rows are read) by
gradient ascent on the exact log-likelihood (forward-backward), and decoded by
Viterbi over padded numpy batches of lines.  Decoded spans that do not touch a
base span are added; base spans always stay.

A line none of whose words has a digit, '@' or '+' has one feature vector for
all its words.  The trained weights are checked once: if "outside" wins for
such words by more than any transition can gain, such lines are all "outside"
by Viterbi too, and are not decoded; otherwise every line is.

Spans are in code points, end exclusive.  Defined results: null and empty
texts have no spans; repeated rows are each searched; an empty table gives an
empty result; extra columns are carried by ``redact`` and ignored by ``find``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import shipped

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
MAX_LABELLED = 2000
EPOCHS = 250
BATCH_LINES = 256
#: Words of a padded batch; a longer line is a batch of its own.
BATCH_WORDS = 1 << 16

_DIGIT = re.compile(r"[0-9]")
_SPECIAL = re.compile(r"[0-9@+]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failed start inside a run of digits fails at every later digit of the run.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[int, int, int]      # kind's place in KINDS, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match holds one '@'; it starts at the longest local part before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            # Nothing before this '@' can start a later match: '@' is no local character.
            done = at + 1
        at = text.find("@", done)


def _luhn(digits: str | list[str]) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Base spans ordered by kind, then start."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := q.lstrip("0")) <= 3 and int(p or 0) <= 255 for q in m[0].split(".")):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 37 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# ---------------------------------------------------------------------------
# Labelled table: sentences with marked spans, [kind text].  The examples are
# forms that the base patterns do not cover, and look-alikes that are no
# personal data.  Made up for this table.
# ---------------------------------------------------------------------------
_FRAMES = ["please call {} before noon", "my number is {} and hers too", "{} is where to reach them",
           "write to {} for details", "sent from {} last week", "contact {} or come by"]
_EXAMPLES = {
    "email": ["jo.doe@localhost", "kim@intranet", "ana.b@mailhost", "sam_lee@server", "x.y+tag@host"],
    "ip": ["fe80::1ff:fe23:4567:890a", "2001:db8::ff00:42:8329", "10.0.0.1:8080", "192.168.0.7/24"],
    "card": ["4111/1111/1111/1111", "5500.0000.0000.0004", "4111_1111_1111_1111"],
    "phone": ["(415) 555-0132", "(212) 555-0187", "415-555-0132", "020-7946-0958", "(030) 901-8200",
              "0049-30-901820", "(0)20-7946-0018"],
}
#: Numbers as long as a card's whose check digit is wrong.
_LOOK_ALIKES = ["4111111111111112", "5500000000000005", "1234567890123456", "4111-1111-1111-1112", "30426282943778151"]
_OUTSIDE = [
    "licensed under version 2.0 of the terms", "this work is under CC BY-NC 4.0 today", "version 3 or later applies",
    "in 1999 there were 24 of them", "on 2021-05-06 at 10:30 we met", "it cost $12.50 or 1,250 each",
    "chapter 12, page 345 to 350", "token = \"0641917ea4e9feb9\" was set", "password=e3b3ed3cc8548923d6 was set",
    "order 4207051279108084 was sent", "id 48637 and 30426282943 are listed", "see section 1.2.3 and 4.5",
    "the 3rd of 15 items (12) is gone", "about 100-200 people came", "a+b and c++ are terms", "user @home said so",
    "score 3-2 after 90 minutes", "isbn 978-3-16-148410-0 is printed", "run 12345678 ended", "ratio 16:9 or 4:3",
    "plain words and nothing else here", "the end.", "of and the in to that", "room 101, floor 7", "+1 for that idea",
    "key AKIA0123456789 was found", "sha 9f86d081884c7d65 is listed", "see http://a.example.com/12/3 for more",
]


def labelled_rows() -> list[str]:
    """The sentences of the default labelled table, spans marked as ``[kind text]``."""
    rows = [f.format(f"[{kind} {x}]") for kind, xs in _EXAMPLES.items() for x in xs for f in _FRAMES]
    covered = ["jo.doe@mail.example.com", "10.20.30.40", "4111111111111111", "+1 (415) 555-0132"]
    rows += [f.format(f"[{k} {x}]") for k, x in zip(KINDS, covered) for f in _FRAMES]
    rows += [f.format(x) for x in _LOOK_ALIKES for f in _FRAMES]
    return rows + _OUTSIDE * 4


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r,) for r in labelled_rows()], "sentence string")


_MARK = re.compile(r"\[(\w+) ([^\]]*)\]")


def _parse(sentence: str) -> tuple[list[str], list[int]]:
    words, labels, at = [], [], 0
    for m in _MARK.finditer(sentence):
        outside = _WORD.findall(sentence[at:m.start()])
        inside = _WORD.findall(m[2])
        words += outside + inside
        k = 1 + 2 * KINDS.index(m[1])
        labels += [0] * len(outside) + [k if i == 0 else k + 1 for i in range(len(inside))]
        at = m.end()
    rest = _WORD.findall(sentence[at:])
    return words + rest, labels + [0] * len(rest)


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------
_SHAPE_RUN = re.compile(r"([a0])\1+")
_UPPER, _LETTER = re.compile(r"[A-Z]"), re.compile(r"[^\W\d_]")


def _core(word: str) -> str:
    return word.strip(".,;:!?\"'")


def shape(word: str) -> str:
    """Letters as a, digits as 0, runs collapsed, with a digit count; plain words are one shape.

    A number as long as a card's tells whether its check digit is right.
    """
    if not _SPECIAL.search(word):
        return "w"
    core = _core(word)
    flat = _SHAPE_RUN.sub(r"\1", re.sub(r"[0-9]", "0", _LETTER.sub("a", core)))
    digits = [c for c in core if "0" <= c <= "9"]
    n = len(digits)
    if n < 13:
        return f"{flat[:24]}|{n if n < 8 else 8}"
    return f"{flat[:24]}{'+' if n < 20 and _luhn(digits) else '-'}|13"


def _features(words: list[str]) -> list[list[str]]:
    shapes = ["^", *map(shape, words), "$"]
    loose = [s.split("|")[0] for s in shapes]
    return [["bias", f"s={shapes[i]}", f"c={loose[i]}", f"p={loose[i - 1]}", f"n={loose[i + 1]}",
             f"pc={loose[i - 1]}~{loose[i]}", f"cn={loose[i]}~{loose[i + 1]}"] for i in range(1, len(shapes) - 1)]


class Crf:
    """Weights of a trained chain: feature -> label scores, and label transitions."""

    def __init__(self, known: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.known, self.weights, self.moves = known, weights, moves
        self._rows: dict[tuple, np.ndarray] = {}

    def scores(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(LABELS)))
        for i, names in enumerate(_features(words)):
            out[i] = self.weights[[self.known[f] for f in names if f in self.known]].sum(axis=0)
        return out

    def plain_is_outside(self) -> bool:
        """Whether lines of plain words only are all "outside" for certain."""
        gain = 2 * max(0.0, float((self.moves - self.moves[0, 0]).max()))
        for words in (["x"], ["x", "x"], ["x", "x", "x"]):
            s = self.scores(words)
            if (s[:, 0] - s[:, 1:].max(axis=1)).min() <= gain:
                return False
        return True


def _allowed() -> np.ndarray:
    """0 for moves that BIO allows, very low for others (I-x only after B-x or I-x)."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for j in range(2, len(LABELS), 2):
        out[:, j] = -1e4
        out[j - 1, j] = out[j, j] = 0
    return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best label paths of a padded batch (lines x words x labels); padding gives 0."""
    lines, steps, n = scores.shape
    best = scores[:, 0] + np.where(np.arange(n) % 2 == 0, np.where(np.arange(n) == 0, 0, -1e4), 0)
    back = np.zeros((lines, steps, n), np.int8)
    for t in range(1, steps):
        through = best[:, :, None] + moves[None]
        back[:, t] = through.argmax(axis=1)
        on = (t < lengths)[:, None]
        best = np.where(on, through.max(axis=1) + scores[:, t], best)
    path = np.zeros((lines, steps), np.int8)
    last = best.argmax(axis=1).astype(np.int8)
    rows = np.arange(lines)
    for t in range(steps - 1, -1, -1):
        path[:, t] = np.where(t < lengths, last, 0)
        if t:
            last = np.where(t < lengths, back[rows, t, last], last)
    return path


def _padded(scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in scores])
    out = np.zeros((len(scores), lengths.max(), len(LABELS)))
    for i, s in enumerate(scores):
        out[i, :len(s)] = s
    return out, lengths


def train(sentences: list[str]) -> Crf:
    """Penalised maximum likelihood by gradient ascent with momentum."""
    data = [(w, y) for w, y in map(_parse, sentences) if w]
    names = sorted({f for w, _ in data for fs in _features(w) for f in fs})
    known = {f: i for i, f in enumerate(names)}
    n, m = len(LABELS), len(data)
    lengths = np.array([len(w) for w, _ in data])
    steps = lengths.max()
    width = 7
    feats = np.full((m, steps, width), len(names))                # the last row of weights stays 0
    gold = np.zeros((m, steps), int)
    for i, (w, y) in enumerate(data):
        feats[i, :len(w)] = [[known[f] for f in fs] for fs in _features(w)]
        gold[i, :len(y)] = y
    on = np.arange(steps) < lengths[:, None]
    start = np.where((np.arange(n) % 2 == 0) & (np.arange(n) > 0), -1e4, 0.0)
    weights, moves, fixed = np.zeros((len(names) + 1, n)), np.zeros((n, n)), _allowed()
    speed_w, speed_m = np.zeros_like(weights), np.zeros_like(moves)

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    gold_w, gold_m = np.zeros_like(weights), np.zeros_like(moves)
    np.add.at(gold_w, (feats[on].reshape(-1), np.repeat(gold[on], width)), 1)
    pair = on[:, 1:]
    np.add.at(gold_m, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
    for _ in range(EPOCHS):
        scores, step = weights[feats].sum(axis=2), moves + fixed
        alpha, beta = np.zeros((m, steps, n)), np.zeros((m, steps, n))
        alpha[:, 0] = scores[:, 0] + start
        for t in range(1, steps):
            new = lse(alpha[:, t - 1, :, None] + step, 1) + scores[:, t]
            alpha[:, t] = np.where(on[:, t, None], new, alpha[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = lse(step + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(on[:, t + 1, None], new, 0)
        z = lse(alpha[:, -1], 1)
        seen = np.exp(alpha + beta - z[:, None, None]) * on[:, :, None]
        grad_w, grad_m = gold_w.copy(), gold_m.copy()
        np.subtract.at(grad_w, feats.reshape(-1), np.repeat(seen.reshape(-1, n), width, axis=0))
        for t in range(1, steps):
            both = np.exp(alpha[:, t - 1, :, None] + step + (scores[:, t] + beta[:, t])[:, None, :] - z[:, None, None])
            grad_m -= (both * on[:, t, None, None]).sum(axis=0)
        grad_w[-1] = 0
        speed_w = 0.9 * speed_w + (grad_w / m - 1e-3 * weights)
        speed_m = 0.9 * speed_m + (grad_m / m - 1e-3 * moves)
        weights, moves = weights + 0.5 * speed_w, moves + 0.5 * speed_m
        weights[-1] = 0
    return Crf(known, weights[:-1], moves + fixed)


def crf_spans(texts: list[str], model: Crf, everywhere: bool) -> list[list[Span]]:
    """Decoded spans of each text."""
    out: list[list[Span]] = [[] for _ in texts]
    held: list[tuple[int, int, list[re.Match]]] = []

    def decode() -> None:
        held.sort(key=lambda h: len(h[2]))
        at = 0
        while at < len(held):
            some = held[at:at + BATCH_LINES]
            while len(some) > 1 and len(some) * len(some[-1][2]) > BATCH_WORDS:
                some = some[:len(some) // 2]
            at += len(some)
            scores, lengths = _padded([model.scores([w[0] for w in words]) for _, _, words in some])
            for (doc, shift, words), path in zip(some, viterbi(scores, lengths, model.moves)):
                i = 0
                while i < len(words):
                    if path[i] == 0:
                        i += 1
                        continue
                    j = i + 1
                    while j < len(words) and path[j] == path[i] + 1:
                        j += 1
                    first, last = words[i][0], words[j - 1][0]
                    start = words[i].start() + len(first) - len(first.lstrip(".,;:!?\"'"))
                    end = words[j - 1].end() - (len(last) - len(last.rstrip(".,;:!?\"'")))
                    if start < end:
                        out[doc].append(((path[i] - 1) // 2, shift + start, shift + end))
                    i = j
        held.clear()

    for doc, text in enumerate(texts):
        if not (everywhere or _SPECIAL.search(text)):
            continue
        at = 0
        for line in text.split("\n"):
            if everywhere or _SPECIAL.search(line):
                words = list(_WORD.finditer(line))
                if words:
                    held.append((doc, at, words))
            at += len(line) + 1
        if len(held) >= 4 * BATCH_LINES:
            decode()
    decode()
    return out


def with_added(base: list[Span], found: list[Span]) -> list[Span]:
    """Base spans and those found spans that touch no base span."""
    return sorted(base + [(int(k), a, b) for k, a, b in found if not any(a < d and c < b for _, c, d in base)])


def _find_batches(model: Crf, everywhere: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            spans = [with_added(b, f) for b, f in zip(base, crf_spans(texts, model, everywhere))]
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts,
                 pa.array([hashlib.sha256(span_text(b).encode()).hexdigest() for b in base]),
                 pa.array([span_text(s) for s in spans]),
                 pa.array([len(s) - len(b) for s, b in zip(spans, base)], pa.int64())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])
    return run


def _trained(spark: SparkSession, labelled: DataFrame | None) -> tuple[Crf, bool]:
    rows = labelled if labelled is not None else labelled_table(spark)
    model = train([r[0] for r in rows.select("sentence").where("sentence IS NOT NULL").orderBy("sentence").limit(MAX_LABELLED).collect()])
    return model, not model.plain_is_outside()


@shipped
def find(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per document: base counts, the digest of the base spans, and all spans."""
    model, everywhere = _trained(docs.sparkSession, labelled)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _find_batches(model, everywhere), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string, n_added long")


def _redact_batches(model: Crf, everywhere: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = [t or "" for t in texts]
            out = []
            for text, found in zip(texts, crf_spans(known, model, everywhere)):
                if text:
                    at, parts = 0, []
                    for k, a, b in sorted(with_added(base_spans(text), found), key=lambda s: (s[1], -s[2])):
                        if a >= at:
                            parts += [text[at:a], f"<{KINDS[k].upper()}>"]
                        at = max(at, b)
                    text = "".join(parts) + text[at:] if parts else text
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "text"])
    return run


@shipped
def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind, e.g. ``<EMAIL>``; ``n_chars`` follows the text."""
    model, everywhere = _trained(docs.sparkSession, labelled)
    names = [f"c{i}" for i in range(len(docs.columns))]
    row = F.struct(*[docs[c].alias(n) for c, n in zip(docs.columns, names) if c != "text"])
    held = docs.select(row.alias("row"), docs["text"].alias("text"))
    schema = T.StructType([held.schema["row"], T.StructField("text", T.StringType())])
    done = held.mapInArrow(_redact_batches(model, everywhere), schema)
    out = []
    for c, n in zip(docs.columns, names):
        value = F.col("text") if c == "text" else F.col(f"row.{n}")
        if c == "n_chars":
            value = F.when(F.col("text").isNull(), value).otherwise(F.length("text").cast(docs.schema[c].dataType))
        out.append(value.alias(c))
    return done.select(*out)
