"""Personal data: fixed patterns with checks, and a linear-chain conditional random field over word shapes.

Patterns find e-mail addresses, IP addresses, card and phone numbers, leftmost and without overlap per kind; a match
that fails its check is dropped. The field reads the words (runs other than blank and 0x09 to 0x0D) of each line as
one chain and adds spans of its own kinds where no pattern has found anything; it is trained on the driver from a
small labelled table and applied to batches of lines in numpy. Null and empty texts have no spans; places count code
points, ends are exclusive; repeated rows give the same spans. Texts of any length are read whole. An empty table gives no
rows. Two columns are read, whatever the others are named.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.tokens import LOWER, NOT_BLANK, RangeHashes, flat, pieces, word_bounds, word_hashes

KINDS = ("email", "ip", "card", "phone", "id", "name")
LABELS = ("other", *KINDS)

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The name of an address reaches back from its @ as far as it can, so one look per @ is enough."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        name = len(before) - len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if name else None
        if domain:
            yield at - name, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all pattern matches that pass their checks, by start, then kind."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if "." in text:
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# The labelled table: sentences with marked places, filled by a seeded rule.

SENTENCES = (
    "Call {name} at {phone} before noon.", "Phone: {phone}", "tel. {phone}", "Reach me on {phone} or {phone}.", "{name} lives here with the dog",
    "His SSN is {id} and hers is {id}.", "ssn {id}", "social security number {id}", "Write to {email} for more.", "mail {email}",
    "The host is {ip} today", "Server {ip} went down.", "Dear {name}, thank you", "signed by {name}", "patient {name} id {id}",
    "Rufen Sie {phone} an.", "Telefon {phone}", "Herzliche Grüße, {name}", "Appelez le {phone} demain", "Téléphone {phone}",
    "Llame al {phone} hoy", "teléfono {phone}", "contact {name} ( {phone} )", "IBAN {id}", "my number is {phone}",
)
#: Sentences without personal data; {number} and {word} stand for what must not be taken for any.
PLAIN = (
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.", "Released under the MIT License.", 'token = "{hex}" and more', "key: {hex}", "in {number} we saw {number} of them",
    "{word} the {word} of {word}, and {word}.", "{word} | {word} | {number} | {word}", "{word}%%% {word}### {word}&&& {word}", "The {word} {word} was {word}.",
    "number {number} of {number}", "page {number}", "{word} {word} {number} {word} {word}", "le {word} de la {word}, {word}.", "der {word} und die {word}.",
    "el {word} de los {word}, {word}.", "{Word} {word} {word}.", "{Word}. {Word} {Word}, {word}", "{WORD}!! {WORD}!! {word}", "the {word} {number}% {word}",
    "see http://{word}.example.org/{word} for {word}", "on {number}-{number} it {word}", "chapter {number}.{number} of {word}", "{word} {word} {word} {word} {word}",
    "{word} {word}. {Word}. {Word}. {Word} {word}", "{word}. {Word} {word}, {Word}", "{word}, {Word}.", "{Word}. {Word}. {word} {word}",
    "{word}.*** {Word}%%% {word},### {Word}&&& {word}$$$", "{word}. {Word} {number} {word} {word}", "{word}, {number} {Word} {word}",
    "{Word} | {Word} | {word}, | {word}. | {number} | {word}", "{word} {number} {Word} {word}.", "{WORD} {WORD}!! {WORD}", "{word}.", "{Word}",
    "{Word} {Word} {Word} {Word} {Word} {Word}", "{Word} {Word}.", "{word} {Word} {Word} {Word}", "{Word}.\n{Word} {Word}", "{word}. {Word} {Word}",
    "{word}. {Word}. {number} {Word}. {word}", "the {word}. {Word} of {word} {Word}.", "{word} {word} {number}% {number} {word}",
)
FILLINGS = 10
_NAMES = "Adams Baker Clark Dubois Evans Fischer García Hughes Ivanova Jensen Keller López Martin Novak Olsen Patel Rossi Schmidt Tanaka Weber".split()
_GIVEN = "Anna Ben Clara David Elena Felix Grace Hugo Irene Jonas Karin Luis Maria Nina Oscar Paula Rosa Stefan Tom Vera".split()
_TITLES = "Mr. Mrs. Ms. Dr. Prof. Herr Frau Madame Monsieur Señor Señora".split()


def _filling(kind: str, rng: random.Random) -> str:
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = "".join(rng.choice("th er on an re he in ed nd ha en ti es or at is it ar te se la de que ou ein sch ung ción é è ç ê ñ í ó ö ü ä ß eau".split()) for _ in range(rng.randint(1, 4)))
    made = {
        "phone": [f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"0{digits(3)}/{digits(6)}", f"0{digits(2)} {digits(4)} {digits(4)}"],
        "id": [f"{digits(3)}-{digits(2)}-{digits(4)}", f"DE{digits(2)} {digits(4)} {digits(4)} {digits(4)} {digits(4)} {digits(2)}"],
        "email": [f"{word}[at]{word}.com", f"{word}(at){word}.org"],
        "ip": [f"{digits(4)}:db8:{digits(1)}::{digits(2)}", f"fe80::{digits(4)}:{digits(3)}"],
        "name": [f"{rng.choice(_TITLES)} {rng.choice(_GIVEN)} {rng.choice(_NAMES)}", f"{rng.choice(_TITLES)} {rng.choice(_NAMES)}"],
        "number": [digits(rng.randint(1, 4)), digits(16), f"{digits(1)}.{digits(1)}.", f"{digits(2)},{digits(3)}", f"{digits(3)}.{digits(3)}.{digits(3)}.{digits(3)}", digits(9)],
        "hex": ["".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((8, 32, 40))))],
        "word": [word, word, f"{word}ly", f"{word}ed"], "Word": [word.capitalize()], "WORD": [word.upper()],
    }
    return rng.choice(made[kind])


def labelled_table(seed: int = 1) -> list[list[tuple[str, str]]]:
    """Lines of (word, label): every sentence filled FILLINGS times."""
    rng, lines = random.Random(seed), []
    for sentence in [*SENTENCES, *PLAIN] * FILLINGS:
        line = []
        for part in re.split(r"(\{\w+\})", sentence):
            kind = part[1:-1] if part.startswith("{") else None
            text = _filling(kind, rng) if kind else part
            if line and text and not text[0].isspace() and line[-1][2]:
                word, label, _ = line.pop()
                text, kind = word + text, label if label in KINDS else kind
            words = text.split()
            line += [(w, kind if kind in KINDS else "other", False) for w in words]
            if line and text and not text[-1].isspace():
                line[-1] = (line[-1][0], line[-1][1], True)
        lines.append([(w, label) for w, label, _ in line])
    return lines


# Features: each gives every word a hash; hashes seen SEEN times or more in the table have weights, all others share one set.

SEEN = 4
_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[0x61:0x7B] = ord("x")
_CLASSES[0x80:] = ord("x")
_CLASSES[0x41:0x5B] = ord("X")
_CLASSES[0x30:0x3A] = ord("d")


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chain: np.ndarray) -> list[np.ndarray]:
    """One array of hashes per feature: shape, shape with run lengths, word, and the shapes and words on both sides.

    ``chain`` numbers the line of each word; what lies beyond a line is a number of its own.
    """
    classes = _CLASSES[data]
    new = np.ones(len(data), bool)
    new[1:] = classes[1:] != classes[:-1]
    new[starts] = True
    run = np.concatenate([[0], np.cumsum(new)])
    shape = RangeHashes(classes[new]).of(run[starts], run[starts] + run[ends] - run[starts])
    full = RangeHashes(classes).of(starts, ends)
    word = word_hashes(LOWER[data], starts, ends)

    def beside(values: np.ndarray, step: int) -> np.ndarray:
        other = np.full(len(values), step % 7, np.uint64)
        if len(values) > abs(step):
            here, there = (slice(-step, None), slice(None, step)) if step < 0 else (slice(None, -step), slice(step, None))
            other[here] = np.where(chain[here] == chain[there], values[there], other[here])
        return other

    return [shape, full, word, beside(shape, -1), beside(word, -1), beside(shape, 1), beside(word, 1), beside(word, -2)]


def _numbers(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each hash among the known ones, from 1; 0 for others."""
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 1, 0)


class Field(NamedTuple):
    """A trained field: known hashes and weights by feature (one per label), and weights of neighbouring labels."""

    known: list[np.ndarray]
    weights: list[np.ndarray]
    moves: np.ndarray

    def emissions(self, hashes: list[np.ndarray]) -> np.ndarray:
        total = np.zeros((len(hashes[0]), len(LABELS)), np.float32)
        for own, known, weights in zip(hashes, self.known, self.weights):
            total += weights[_numbers(own, known)]
        return total

    def decode(self, emissions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The best label of every word, by Viterbi over all chains at once; chain i spans bounds[i] to bounds[i + 1]."""
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        first, lengths = bounds[:-1][order], lengths[order]
        back = np.zeros(emissions.shape, np.int8)
        best = np.zeros(len(emissions), np.int64)
        active = int((lengths > 0).sum())
        if not active:
            return best
        score = self.moves[0] + emissions[first[:active]]
        ended = np.zeros((active, len(LABELS)), np.float32)
        for step in range(1, int(lengths[0]) + 1):
            now = int(np.searchsorted(-lengths, -step, side="left"))
            ended[now:len(score)] = score[now:]
            score = score[:now]
            if not now:
                break
            reach = score[:, :, None] + self.moves[None]
            at = first[:now] + step
            back[at] = reach.argmax(axis=1)
            score = reach.max(axis=1) + emissions[at]
        label = (ended + self.moves[:, 0]).argmax(axis=1)
        last = first[:active] + lengths[:active] - 1
        best[last] = label
        for step in range(1, int(lengths[0])):
            now = int(np.searchsorted(-lengths, -step, side="left"))
            label = back[last[:now] - step + 1, label[:now]]
            best[last[:now] - step] = label
        return best

    def can_leave_other(self, emissions: np.ndarray) -> np.ndarray:
        """Words that could be anything but ``other``: if no word of a line can, Viterbi would give ``other`` throughout.

        Entering, staying and leaving other labels is credited at its best, so no line is passed over that could win.
        """
        stay = self.moves[0, 0]
        credit = max(0.0, float(self.moves[0, 1:].max() + self.moves[1:, 0].max() - 2 * stay)) + max(0.0, float(self.moves[1:, 1:].max() - stay))
        return (emissions[:, 1:].max(axis=1) - emissions[:, 0]) + credit >= 0


def _lines_of(table: list[list[tuple[str, str]]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    data = np.frombuffer("\n".join(" ".join(w for w, _ in line) for line in table).encode(), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), NOT_BLANK)
    chain = np.cumsum(data == 0x0A)[starts]
    labels = np.array([LABELS.index(label) for line in table for _, label in line])
    return features(data, starts, ends, chain), np.searchsorted(chain, np.arange(len(table) + 1)), labels


def trained(table: list[list[tuple[str, str]]], rounds: int = 80, rate: float = 0.1, decay: float = 0.002) -> Field:
    """Fit a field to labelled lines by maximum likelihood (forward-backward gradients, Adam steps)."""
    hashes, bounds, labels = _lines_of(table)
    known = [values[counts >= SEEN] for values, counts in (np.unique(h, return_counts=True) for h in hashes)]
    numbers = [_numbers(h, k) for h, k in zip(hashes, known)]
    every = range(len(numbers))
    lengths, many, kinds = np.diff(bounds), len(bounds) - 1, len(LABELS)
    longest = int(lengths.max())
    mask = np.arange(longest)[None] < lengths[:, None]
    place = np.where(mask, bounds[:-1, None] + np.arange(longest)[None], 0)
    values = [*(np.zeros((len(k) + 1, kinds)) for k in known), np.zeros((kinds, kinds))]
    means, spreads = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    true = np.zeros((len(labels), kinds))
    true[np.arange(len(labels)), labels] = 1
    before = np.zeros(len(labels), np.int64)
    before[1:] = labels[:-1]
    before[bounds[:-1]] = 0
    pairs = np.zeros((kinds, kinds))
    np.add.at(pairs, (before, labels), 1)
    np.add.at(pairs, (labels[bounds[1:] - 1], np.zeros(many, int)), 1)
    sorts = [np.argsort(n, kind="stable") for n in numbers]
    groups = [np.unique(n) for n in numbers]
    cuts = [np.searchsorted(n[s], g) for n, s, g in zip(numbers, sorts, groups)]
    total = lambda x, axis: np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis)) + x.max(axis=axis)
    for count in range(1, rounds + 1):
        *weights, moves = values
        scores = sum(weights[k][numbers[k]] for k in every)[place]
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = moves[0] + scores[:, 0]
        for t in range(1, longest):
            ahead[:, t] = total(ahead[:, t - 1][:, :, None] + moves[None], 1) + scores[:, t]
        for t in range(longest - 1, -1, -1):
            if t < longest - 1:
                on = total(moves[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
                behind[:, t] = np.where((t + 1 < lengths)[:, None], on, moves[:, 0])
            else:
                behind[:, t] = moves[:, 0]
        norm = total(ahead[:, 0] + behind[:, 0], 1)
        single = np.exp(ahead + behind - norm[:, None, None])[mask]
        double = np.zeros((kinds, kinds))
        for t in range(1, longest):
            go = t < lengths
            joint = ahead[go, t - 1][:, :, None] + moves[None] + (scores[go, t] + behind[go, t])[:, None, :] - norm[go][:, None, None]
            double += np.exp(joint).sum(axis=0)
        double[0] += np.exp(ahead[:, 0] + behind[:, 0] - norm[:, None]).sum(axis=0)
        double[:, 0] += single[bounds[1:] - 1].sum(axis=0)
        gradients = [*(-decay * w for w in weights), pairs - double - decay * moves]
        for k in every:
            gradients[k][groups[k]] += np.add.reduceat((true - single)[sorts[k]], cuts[k], axis=0)
        for value, gradient, mean, spread in zip(values, gradients, means, spreads):
            mean += 0.1 * (gradient - mean)
            spread += 0.001 * (gradient**2 - spread)
            value += rate * (mean / (1 - 0.9**count)) / (np.sqrt(spread / (1 - 0.999**count)) + 1e-8)
    return Field(known, [v.astype(np.float32) for v in values[:-1]], values[-1].astype(np.float32))


@lru_cache(maxsize=1)
def default_field() -> Field:
    return trained(labelled_table())


def plausible(kind: str, text: str) -> bool:
    """What a labelled span has to hold at least to be of its kind."""
    if kind == "name":
        return text.split()[0] in _TITLES
    digits = sum(c.isdigit() for c in text)
    least, most = {"phone": (6, 15), "id": (7, 34), "ip": (3, 39), "card": (14, 19), "email": (0, len(text))}[kind]
    return least <= digits <= most and (kind != "email" or "at" in text.lower() or "@" in text)


def field_spans(texts: pa.Array, field: Field) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of what the field labels in each text, ends without the marks that close a word."""
    data, offsets = flat(texts)
    starts, ends, first = word_bounds(data, offsets, NOT_BLANK)
    found: list[list[tuple[str, int, int]]] = [[] for _ in range(len(texts))]
    if not len(starts):
        return found
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    chain = np.cumsum(data == 0x0A)[starts] + text
    emissions = field.emissions(features(data, starts, ends, chain))
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(chain)) + 1, [len(chain)]])
    likely = np.add.reduceat(field.can_leave_other(emissions).astype(np.int64), bounds[:-1]) > 0
    if not likely.any():
        return found
    words = np.flatnonzero(np.repeat(likely, np.diff(bounds)))
    labels = field.decode(emissions[words], np.concatenate([[0], np.cumsum(np.diff(bounds)[likely])]))
    hit = np.flatnonzero(labels)
    if not len(hit):
        return found
    places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    same = (np.diff(words[hit]) == 1) & (np.diff(labels[hit]) == 0) & (np.diff(chain[words[hit]]) == 0)
    cut = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(hit)]])
    for a, b in zip(cut[:-1], cut[1:]):
        begin, end, own = starts[words[hit[a]]], ends[words[hit[b - 1]]], text[words[hit[a]]]
        raw = data[begin:end].tobytes()
        begin += len(raw) - len(raw.lstrip(b"\"'<["))
        end -= len(raw) - len(raw.rstrip(b".,;:!?\"'>"))
        if begin < end and plausible(LABELS[labels[hit[a]]], data[begin:end].tobytes().decode()):
            found[own].append((LABELS[labels[hit[a]]], int(places[begin] - places[offsets[own]]), int(places[end] - places[offsets[own]])))
    return found


SPANS = "array<struct<kind:string,start:long,end:long>>"


def found(docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """(key, base, spans) of every document: spans of the patterns, and those together with the ones the field adds."""
    shared = docs.sparkSession.sparkContext.broadcast(field or default_field())
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column("text")
                base = [pattern_spans(t or "") for t in texts.to_pylist()]
                every = []
                for own, added in zip(base, field_spans(texts, shared.value)):
                    new = [s for s in added if all(s[2] <= a or b <= s[1] for _, a, b in own)]
                    every.append(sorted(own + new, key=lambda s: (s[1], KINDS.index(s[0]))))
                rows = lambda spans: pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in spans], kind)
                yield pa.RecordBatch.from_arrays([piece.column("key"), rows(base), rows(every)], names=["key", "base", "spans"])

    return docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text")).mapInArrow(run, f"key long, base {SPANS}, spans {SPANS}")
