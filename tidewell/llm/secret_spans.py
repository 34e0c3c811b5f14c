"""Secrets in texts: fixed patterns, and a linear-chain conditional random field decoded by Viterbi.

Base spans, per kind the leftmost non-overlapping matches: ``assign`` (a password-like
name, a sign, a value of six or more characters), ``access`` (AKIA and 16 or more
capitals or digits) and ``hex`` (24 or more lower-case hexadecimal digits). A
span is the whole match, in code points, its end exclusive.

The field tags tokens (runs of letters, digits and non-ASCII characters, and runs of
other non-space characters) as beginning a secret, inside one, or outside. Features of a
token: its length, the kinds of its characters, how they alternate, whether it touches
its neighbours or starts a line, its own, the previous, the one before and the next word
(hashed), and the share of digits and signs in the whole text. It learns from
the tags that the base spans give to a bounded sample of excerpts; its spans (kind ``crf``)
are added to the base ones.

Defined results: a null or empty text has no spans. Without a sample that holds
a secret the field adds nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.arrays import ALNUM, WHITE, flat, mix, per_slice, word_hashes

SAMPLE = 4000
EXCERPT = 2000
KINDS = ("assign", "access", "hex", "crf")
# The patterns of the base spans.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24}")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

Spans = list[tuple[int, int, int]]


def base_spans(text: str) -> Spans:
    """(start, kind, end) of the fixed patterns, sorted."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if LONG_HEX.search(text):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    return sorted(found)


def joined(spans: Spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# Tokens and features ---------------------------------------------------------------------------------------

WORDS = 1024
_CLASS = np.zeros(256, np.uint8)  # one bit per kind of byte
for _bit, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), b"=:", b"\"'`", b"+/_-", range(128, 256))):
    _CLASS[list(_bytes)] |= 1 << _bit
_CLASS[(_CLASS == 0) & ~WHITE] = 1 << 7
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_GROUP = np.where(ALNUM, np.uint8(1), np.uint8(2))
_GROUP[WHITE] = 0
SIZES = (12, 256, 60, 8, WORDS, WORDS, WORDS, WORDS, 25)
_FIRST = np.concatenate([[0], np.cumsum(SIZES)])


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the tokens of all texts."""
    group = _GROUP[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = group[1:] != group[:-1]
    edge[bounds] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    real = group[starts] > 0 if len(data) else np.zeros(len(starts), bool)
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def features(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> np.ndarray:
    """(kinds of feature, tokens) numbers of the weights that apply."""
    n = len(starts)
    if not n:
        return np.zeros((len(SIZES), 0), np.int64)
    length = ends - starts
    classes = _CLASS[data]

    def count(mask):
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(mask, out=total[1:])
        return total

    digits, hexed = count(classes == 4), count(_HEX[data])
    turns = count(np.concatenate([[False], classes[1:] != classes[:-1]]))
    held = np.bitwise_or.reduceat(classes, np.stack([starts, np.minimum(ends, len(data) - 1)], 1).ravel())[::2]
    n_digits = digits[ends] - digits[starts]
    turned = (turns[ends] - turns[np.minimum(starts + 1, len(data))]).clip(0)
    shape = (4 * n_digits // length) * 12 + np.minimum(5, turned * 8 // length) * 2 + (hexed[ends] - hexed[starts] == length)
    same = text[1:] == text[:-1]
    glued = np.zeros(n + 1, np.int64)
    glued[1:-1] = same & (starts[1:] == ends[:-1])
    before = data[np.maximum(starts - 1, 0)]
    line = (starts == bounds[text]) | (before == 10)
    word = (word_hashes(data, starts, ends) % np.uint64(WORDS - 1)).astype(np.int64) + 1
    around = np.zeros((3, n), np.int64)
    around[0, 1:] = word[:-1] * same
    around[1, :-1] = word[1:] * same
    around[2, 2:] = word[:-2] * (same[1:] & same[:-1])
    size = np.maximum(np.diff(bounds), 1)
    signs = count(classes >= 8) - count(classes == 64)
    share = lambda c: np.minimum(4, 50 * (c[bounds[1:]] - c[bounds[:-1]]) // size)
    file = share(digits) * 5 + share(signs)
    kinds = [
        np.minimum(11, np.log2(length) * 2).astype(np.int64), held.astype(np.int64), shape,
        glued[:-1] * 4 + glued[1:] * 2 + line, word, around[0], around[1], around[2], file[text],
    ]
    return np.stack([k + _FIRST[i] for i, k in enumerate(kinds)]).astype(np.int64)


# The field ------------------------------------------------------------------------------------------------

OUT, BEGIN, INSIDE = 0, 1, 2


@dataclass
class Field:
    """Weights per feature and tag, and of tag pairs; a text begins and ends beside an outside tag."""

    emit: np.ndarray
    move: np.ndarray

    def scores(self, found: np.ndarray) -> np.ndarray:
        total = np.zeros((found.shape[1], 3), np.float32)
        for row in found:
            total += self.emit[row]
        return total

    def decode(self, scores: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The best tags (Viterbi).

        A token whose outside score exceeds its others by more than moves can ever
        regain is outside on every best path, so only the runs between such tokens are
        searched; a run has an outside tag on either side.
        """
        tags = np.zeros(len(scores), np.int8)
        a, s, b = np.meshgrid(range(3), (BEGIN, INSIDE), range(3), indexing="ij")
        gain = (self.move[a, s] + self.move[s, b] - self.move[a, OUT] - self.move[OUT, b]).max()
        open_ = np.flatnonzero(scores[:, 1:].max(axis=1) - scores[:, 0] + gain >= 0) if len(scores) else np.zeros(0, int)
        if not len(open_):
            return tags
        new = np.flatnonzero((np.diff(open_, prepend=-9) != 1) | (np.diff(text[open_], prepend=-1) != 0))
        begin, size = open_[new], np.diff(np.append(new, len(open_)))
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        best = self.move[OUT] + scores[begin]
        back, final = [], np.zeros((len(begin), 3), np.float32)
        for t in range(1, size[0] + 1):
            live = int(np.searchsorted(-size, -t, "right"))  # runs of t tokens or more
            more = int(np.searchsorted(-size, -(t + 1), "right"))
            final[more:live] = best[more:live] + self.move[:, OUT]
            if not more:
                break
            ways = best[:more, :, None] + self.move[None]
            back.append(ways.argmax(axis=1).astype(np.int8))
            best = ways.max(axis=1) + scores[begin[:more] + t]
        tag = final.argmax(axis=1).astype(np.int8)
        for t in range(size[0] - 1, -1, -1):
            live = int(np.searchsorted(-size, -(t + 1), "right"))
            tags[begin[:live] + t] = tag[:live]
            if t:
                more = back[t - 1]
                tag[: len(more)] = more[np.arange(len(more)), tag[: len(more)]]
        return tags


def gold_tags(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tags that the base spans give to the tokens of one text (byte positions)."""
    tags = np.zeros(len(starts), np.int8)
    spans = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    spans += [(s, e) for s, kind, e in base_spans(text) if kind]
    for start, end in spans:
        lo = len(text[:start].encode())
        hi = lo + len(text[start:end].encode())
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi)
        tags[first:last] = INSIDE
        if first < last:
            tags[first] = BEGIN
    return tags


def train(texts: list[str], epochs: int = 30, batch: int = 128, longest: int = 60, decay: float = 1e-3) -> Field | None:
    """Maximum likelihood with a quadratic penalty, by Adam over lines; four plain lines for each with a secret."""
    rng = np.random.default_rng(11)
    hot, plain = [], []
    for text in texts:
        data, bounds = flat(pa.array([text], pa.large_string()))
        starts, ends, owner = tokens(data, bounds)
        found, gold = features(data, bounds, starts, ends, owner), gold_tags(text, starts, ends)
        for lo in range(0, len(starts), longest):
            part = (found[:, lo : lo + longest], gold[lo : lo + longest])
            (hot if part[1].any() else plain).append(part)
    if not hot:
        return None
    lines = hot + [plain[i] for i in rng.permutation(len(plain))[: 4 * len(hot)]]
    emit, move = np.zeros((_FIRST[-1], 3)), np.zeros((3, 3))
    state = [np.zeros_like(x) for x in (emit, move, emit, move)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(lines))
        for at in range(0, len(order), batch):
            group = [lines[i] for i in order[at : at + batch]]
            n, size = len(group), np.array([len(g) for _, g in group])
            steps = size.max()
            found, gold = np.zeros((n, len(SIZES), steps), np.int64), np.zeros((n, steps), np.int64)
            for i, (f, g) in enumerate(group):
                found[i, :, : len(g)], gold[i, : len(g)] = f, g
            inside = np.arange(steps) < size[:, None]
            score = emit[found].sum(axis=1)
            score[~inside] = (0, -1e9, -1e9)  # the padding is outside
            ahead, behind = np.zeros((n, steps, 3)), np.zeros((n, steps, 3))
            ahead[:, 0] = move[OUT] + score[:, 0]
            for t in range(1, steps):
                ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + move, axis=1) + score[:, t]
            behind[:, -1] = move[:, OUT]
            for t in range(steps - 2, -1, -1):
                behind[:, t] = np.logaddexp.reduce(move + (score[:, t + 1] + behind[:, t + 1])[:, None], axis=2)
            total = np.logaddexp.reduce(ahead[:, -1] + move[:, OUT], axis=1)
            chance = np.exp(ahead + behind - total[:, None, None])
            pairs = ahead[:, :-1, :, None] + move + (score[:, 1:] + behind[:, 1:])[:, :, None] - total[:, None, None, None]
            grad_move = np.where(inside[:, 1:, None, None], np.exp(pairs), 0).sum(axis=(0, 1))
            np.subtract.at(grad_move, (gold[:, :-1][inside[:, 1:]], gold[:, 1:][inside[:, 1:]]), 1)
            grad_move[OUT] += chance[:, 0].sum(axis=0)
            np.subtract.at(grad_move[OUT], gold[:, 0], 1)
            wrong = chance - np.eye(3)[gold]
            wrong[~inside] = 0
            grad_emit = np.zeros_like(emit)
            for k in range(len(SIZES)):
                np.add.at(grad_emit, found[:, k], wrong)
            step += 1
            for x, g, i in ((emit, grad_emit / n + decay * emit, 0), (move, grad_move / n + decay * move, 1)):
                state[i] += 0.1 * (g - state[i])
                state[i + 2] += 0.001 * (g * g - state[i + 2])
                x -= 0.05 * (state[i] / (1 - 0.9**step)) / (np.sqrt(state[i + 2] / (1 - 0.999**step)) + 1e-8)
    return Field(emit.astype(np.float32), move.astype(np.float32))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field | None:
    """Train on excerpts of at most ``sample`` rows, chosen by a hash of key and text, wherever they lie in a text.

    Rows of equal key and text count once, so that neither repeated nor null keys empty the sample, nor copies fill it.
    """
    order = F.xxhash64(F.col(key).cast("string"), F.col(text), F.lit("secret"))
    start = F.pmod(order, F.greatest(F.char_length(F.col(text)) - EXCERPT, F.lit(1))).cast("int") + 1
    rows = docs.where(F.col(text).isNotNull()).select(
        order.alias("place"), F.substring(F.col(text), start, F.lit(EXCERPT)).alias("text")
    )
    # the lowest hashes lie below a bound that leaves about 1.5 samples, so tasks send few rows however many they are
    unlike = rows.agg(F.approx_count_distinct("place")).first()[0]
    share = min(1.0, 1.5 * sample / max(unlike, 1))
    low = rows.where(F.col("place") <= min(int(-(2**63) + share * 2**64), 2**63 - 1)).dropDuplicates(["place"])
    return train([r["text"] for r in low.orderBy("place", "text").limit(sample).collect()])


def field_spans(field: Field, data: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """Byte spans of the decoded secrets by text number, relative to the text."""
    starts, ends, text = tokens(data, bounds)
    tags = field.decode(field.scores(features(data, bounds, starts, ends, text)), text)
    spans: dict[int, list[tuple[int, int]]] = {}
    last = -2
    for i in np.flatnonzero(tags):
        own = spans.setdefault(int(text[i]), [])
        lo, hi = int(starts[i] - bounds[text[i]]), int(ends[i] - bounds[text[i]])
        if tags[i] == INSIDE and last == i - 1 and own:
            own[-1] = (own[-1][0], hi)
        else:
            own.append((lo, hi))
        last = i
    return spans


def all_spans(field: Field | None, texts: pa.Array) -> list[tuple[Spans, Spans]]:
    """(base spans, all spans) of each text, in code points."""
    data, bounds = flat(texts)
    extra = field_spans(field, data, bounds) if field is not None and len(data) else {}
    result = []
    for i, text in enumerate(texts.to_pylist()):
        base = base_spans(text)
        spans = list(base)
        if i in extra:
            lead = np.concatenate([[0], np.cumsum((data[bounds[i] : bounds[i + 1]] & 0xC0) != 0x80)])
            spans += [(int(lead[lo]), 3, int(lead[hi])) for lo, hi in extra[i]]
        result.append((base, sorted(spans)))
    return result


def find_secrets(docs: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans) of every row; both are arrays of (kind, start, end), in order."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(spans):
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]

    def make():
        def work(batch, texts):
            found = all_spans(field, texts)
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([rows(b) for b, _ in found], kind), pa.array([rows(s) for _, s in found], kind)],
                ["id", "base", "spans"],
            )

        return work

    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    span = "array<struct<kind: string, start: long, end: long>>"
    return source.mapInArrow(per_slice(make, "text"), f"id long, base {span}, spans {span}").withColumnRenamed("id", key)


def redact(docs: DataFrame, field: Field | None, text: str = "text", length: str = "n_chars", mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every span, overlapping ones as one, replaced by ``mark``, and the length column kept true."""
    names = docs.columns

    def make():
        def work(batch, texts):
            found = all_spans(field, texts)
            out = batch.column(text).to_pylist()
            sizes = batch.column(length).to_pylist() if length in names else None
            for i, (_, spans) in enumerate(found):
                if spans:
                    parts, at = [], 0
                    merged = []
                    for start, _, end in spans:
                        if merged and start <= merged[-1][1]:
                            merged[-1][1] = max(end, merged[-1][1])
                        else:
                            merged.append([start, end])
                    for start, end in merged:
                        parts += [out[i][at:start], mark]
                        at = end
                    out[i] = "".join([*parts, out[i][at:]])
                    if sizes:
                        sizes[i] = len(out[i])
            columns = [batch.column(n) for n in names]
            columns[names.index(text)] = pa.array(out, columns[names.index(text)].type)
            if sizes:
                columns[names.index(length)] = pa.array(sizes, columns[names.index(length)].type)
            return pa.RecordBatch.from_arrays(columns, names)

        return work

    return docs.mapInArrow(per_slice(make, text), docs.schema)
