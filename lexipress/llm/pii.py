"""Personal data: base patterns, and a semi-Markov conditional random field.

Base patterns give the spans that always stand.  The field looks at what they leave:
around digits, @ signs and spelt-out addresses a text is cut into tokens, segments of
at most ``LONGEST`` tokens are candidates, and features of a whole segment (its groups
of digits, separators, checksums, neighbours and the cue word before it) score it for
each kind.  Dynamic programming over the tokens chooses boundaries and kinds of all
segments together; everything else is outside, token by token.

Weights are trained by maximum likelihood (forward-backward over the same segments, with
adaptive gradient steps) on sentences that this module makes from a fixed seed, decoys such as
dates, versions and prices among them.  Text away from any trigger never enters the
dynamic programming, so cost follows the triggers, not the length of the texts.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from . import common

#: Kinds in the order in which spans are listed; the last two come from the field alone.
KINDS = ("email", "ip", "card", "phone", "secret", "id")
LONGEST = 16
#: Characters of context on either side of a trigger.
AROUND = 60
#: A stretch grows by at most so many characters to end at white space.
SNAP = 200

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the patterns, leftmost without overlap in each kind, failing matches dropped."""
    out: list[tuple[str, int, int]] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# Candidate segments

_TRIGGER = re.compile(r"[0-9@]+|(?<=[\[({< ])[Aa][Tt](?=[\])}> ])(?=.{1,40}[Dd][Oo][Tt])")
_TOKEN = re.compile(r"[^\W_]+|\S")
_NUMBER_MARKS = frozenset("+-().")
_ADDRESS_MARKS = frozenset("@._%+-[](){}<>")
#: Cue words before a segment, by what they announce.
CUES = {
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "cell", "whatsapp", "contact"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "pan"),
    "ip": ("ip", "host", "server", "address", "ipv4"),
    "email": ("email", "mail", "contact", "write"),
    "secret": ("token", "key", "secret", "password", "passwd", "apikey", "bearer", "credential"),
    "id": ("ssn", "social", "security", "passport", "identity"),
    "version": ("version", "v", "release", "license", "isbn", "sha", "commit", "revision", "order", "page", "chapter"),
}
_CUE_OF = {w: k for k, words in CUES.items() for w in words}


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around triggers, cut at white space."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    cut = []
    for a, b in out:
        low, high = max(0, a - SNAP), min(len(text), b + SNAP)
        while a > low and not text[a].isspace() and not text[a - 1].isspace():
            a -= 1
        while b < high and not text[b].isspace():
            b += 1
        cut.append((a, b) if not cut or a >= cut[-1][1] else (cut.pop()[0], b))
    return cut


def _segment_features(text: str, a: int, b: int, tokens: Tokens, i: int, j: int) -> list[str] | None:
    """Names of the features of the segment a..b (tokens i..j), or None if it cannot be an entity."""
    s = text[a:b]
    low = s.lower()
    groups = re.findall(r"[0-9]+", s)
    n = sum(map(len, groups))
    letters = any(c.isalpha() for c in s)
    out = ["bias"]
    if letters:
        at = "@" in s or re.search(r"(?<![a-z])at(?![a-z])", low) is not None
        dot = re.search(r"[.]|(?<![a-z])dot(?![a-z])", low) is not None
        if at and dot:
            whole = re.fullmatch(r"[a-z0-9._%+-]+(?: ?(?:\.|[\[({<]?dot[\])}>]?) ?[a-z0-9_%+-]+)* ?(?:@|[\[({<]?at[\])}>]?) ?[a-z0-9-]+(?: ?(?:\.|[\[({<]?dot[\])}>]?) ?[a-z0-9-]+)+", low)
            spelt = re.search(r"(?<![a-z])dot(?![a-z])|[\[({<]at", low) is not None
            if not whole:
                return None
            out += ["address", f"address:{'@' if '@' in s else 'at'}:{'spelt' if spelt else 'plain'}"]
            tail = re.search(r"([a-z]+)$", low)
            out.append("tail:" + ("short" if tail and 2 <= len(tail[1]) <= 4 else "other"))
        elif j - i == 1 and n and len(s) >= 20:
            out += ["opaque", "opaque:hex" if re.fullmatch(r"[0-9a-f]+", low) else "opaque:mixed", f"opaque:{'long' if len(s) >= 32 else 'mid'}"]
        else:
            return None
    else:
        if n < 7:
            return None
        marks = "".join(sorted({c for c in s if not c.isdigit()}))
        sizes = "-".join(str(min(len(g), 20)) for g in groups[:6])
        out += [f"digits:{n}", f"groups:{sizes}", f"marks:{marks}", f"n_groups:{min(len(groups), 6)}"]
        if s[0] == "+":
            out.append("plus")
        if "(" in s or ")" in s:
            out.append("paired" if s.count("(") == s.count(")") == 1 else "unpaired")
        if 13 <= n <= 19 and not set(marks) - {" ", "-"}:
            out.append("luhn" if luhn(_digits(s)) else "no-luhn")
            out.append("card-shape:" + ("luhn" if luhn(_digits(s)) and (len(groups) == 1 or len({len(g) for g in groups[:-1]}) == 1 and len(groups[0]) == 4) else "no"))
        if len(groups) == 4 and marks == ".":
            out.append("octets" if all(int(g[:9]) <= 255 for g in groups) else "no-octets")
        if re.fullmatch(r"(19|20)[0-9]{2}[-./]?[01][0-9][-./]?[0-3][0-9]|[0-3]?[0-9][-./][01]?[0-9][-./](19|20)[0-9]{2}", s):
            out.append("date")
        if len(groups) == 3 and sizes == "3-2-4" and marks in (" ", "-"):
            out.append("3-2-4")
        if 3 <= len(groups) <= 4 and sizes.endswith("3-3-4") or sizes == "3-4" or sizes.endswith("3-4"):
            out.append("local-phone")
    before, after = text[a - 1 : a], text[b : b + 1]
    nxt = text[b + 1 : b + 2]
    if before.isalnum() or before in {"-", "+", "$", "#", "@", "_", "/"}:
        out.append("left:" + ("alnum" if before.isalnum() else before))
    if before == "." and a >= 2 and text[a - 2].isalnum():
        out.append("left:dot")
    if after.isalnum() or after in {"@", "_", "%", "/"} or after in {"-", "."} and nxt.isalnum():
        out.append("right:" + ("alnum" if after.isalnum() else after))
    if after == " " and nxt.isdigit() and not letters:
        out.append("right:digits")
    if before == " " and a >= 2 and text[a - 2].isdigit() and not letters:
        out.append("left:digits")
    for k in range(i - 1, max(-1, i - 6), -1):
        word = text[tokens[k][0] : tokens[k][1]].lower()
        if word in _CUE_OF:
            out.append("cue:" + _CUE_OF[word])
            break
    return out


class Tokens:
    """Begins and ends of a region's tokens, eight bytes each."""

    def __init__(self, text: str, a: int, b: int):
        self.starts, self.ends = array("i"), array("i")
        for m in _TOKEN.finditer(text, a, b):
            self.starts.append(m.start())
            self.ends.append(m.end())

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, k: int) -> tuple[int, int]:
        return self.starts[k], self.ends[k]


def starting(text: str, tokens: Tokens, i: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, list[str]]]:
    """(last token + 1, features) of the candidate segments that begin with token i; taken: spans that stand already, in order."""
    start, stop = tokens[i]
    first = text[start]
    if not (first.isalnum() or first in "+("):
        return
    number, address, was = True, True, stop
    for j in range(i, min(i + LONGEST, len(tokens))):
        s, e = tokens[j]
        gap = text[was:s] if j > i else ""
        k = bisect.bisect_right(taken, s, key=lambda span: span[1])
        if "\n" in gap or len(gap) > 1 or k < len(taken) and taken[k][0] < e:
            return
        was, t = e, text[s:e]
        digit, alnum = t.isdigit() and t.isascii(), t[0].isalnum()
        number = number and (digit or t in _NUMBER_MARKS)
        address = address and (alnum or t in _ADDRESS_MARKS)
        if not (number or address):
            return
        if alnum and (j == i or number or address):
            found = _segment_features(text, start, e, tokens, i, j + 1)
            if found:
                yield j + 1, found


def lattice(text: str, a: int, b: int, taken: list[tuple[int, int]]) -> tuple[Tokens, list[tuple[int, int, list[str]]]]:
    """Tokens of a region and all its candidate segments (first token, last + 1, features), for short texts."""
    tokens = Tokens(text, a, b)
    return tokens, [(i, j, names) for i in range(len(tokens)) for j, names in starting(text, tokens, i, taken)]


# The field

class Field:
    """Weights by feature and kind, and of a kind after another (outside: last)."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weights = np.zeros((0, len(KINDS)))
        self.follow = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def known(self, names: list[str]) -> np.ndarray:
        return np.array([self.index[x] for x in names if x in self.index], dtype=np.int64)

    def decode(self, n: int, segments: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, int]]:
        """The best choice of segments (first, last + 1, kind) of n tokens."""
        begin: dict[int, list[tuple[int, list[str]]]] = {}
        for i, j, names in segments:
            begin.setdefault(i, []).append((j, names))
        return self.decode_from(n, lambda i: begin.get(i, ()))

    def decode_from(self, n: int, segments: Callable[[int], Iterable[tuple[int, list[str]]]]) -> list[tuple[int, int, int]]:
        """The same, with the segments (last + 1, features) that begin at a token asked for when it is reached.

        A segment has ``LONGEST`` tokens at most, so scores are held for that many places alone,
        and for each place and state eight bytes tell where its best path came from.
        """
        outside = len(KINDS)
        states = range(outside + 1)
        follow = self.follow.tolist()
        low = float("-inf")
        came, state = array("i", [-1]) * ((n + 1) * (outside + 1)), array("b", [-1]) * ((n + 1) * (outside + 1))
        held: dict[int, list[float]] = {0: [low] * outside + [0.0]}
        for i in range(n):
            here = held.pop(i)
            score, was = max((here[y] + follow[y][outside], y) for y in states)
            row = held.setdefault(i + 1, [low] * (outside + 1))
            row[outside] = score
            at = (i + 1) * (outside + 1) + outside
            came[at], state[at] = i, was
            enter: list[tuple[float, int]] = []
            for j, names in segments(i):
                enter = enter or [max((here[y] + follow[y][x], y) for y in states) for x in range(outside)]
                row = held.setdefault(j, [low] * (outside + 1))
                for x, own in enumerate(self.weights[self.known(names)].sum(axis=0).tolist()):
                    if (score := enter[x][0] + own) > row[x]:
                        row[x] = score
                        at = j * (outside + 1) + x
                        came[at], state[at] = i, enter[x][1]
        out, j, last = [], n, held[n]
        y = max(states, key=lambda y: last[y])
        while j:
            at = j * (outside + 1) + y
            if y != outside:
                out.append((came[at], j, y))
            j, y = came[at], state[at]
        return out[::-1]

    def gradient(self, n: int, segments: list[tuple[int, int, np.ndarray]], gold: set[tuple[int, int, int]], g_weights: np.ndarray, g_follow: np.ndarray) -> None:
        """Adds the gradient of the log-likelihood of ``gold`` among all choices."""
        outside = len(KINDS)
        scores = [self.weights[f].sum(axis=0) for _, _, f in segments]
        lse = np.logaddexp.reduce
        starts: list[list[int]] = [[] for _ in range(n + 1)]
        stops: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, j, _) in enumerate(segments):
            starts[i].append(k)
            stops[j].append(k)
        alpha = np.full((n + 1, outside + 1), -np.inf)
        alpha[0, outside] = 0.0
        enter = np.empty((n + 1, outside + 1))
        enter[0] = lse(alpha[0][:, None] + self.follow, axis=0)
        for j in range(1, n + 1):
            alpha[j, outside] = enter[j - 1, outside]
            for k in stops[j]:
                alpha[j, :outside] = np.logaddexp(alpha[j, :outside], enter[segments[k][0], :outside] + scores[k])
            enter[j] = lse(alpha[j][:, None] + self.follow, axis=0)
        total = lse(alpha[n])
        beta = np.zeros((n + 1, outside + 1))
        for i in range(n - 1, -1, -1):
            ahead = np.full(outside + 1, -np.inf)  # of what starts at i, by kind
            ahead[outside] = beta[i + 1, outside]
            for k in starts[i]:
                j = segments[k][1]
                value = scores[k] + beta[j, :outside]
                ahead[:outside] = np.logaddexp(ahead[:outside], value)
                share = np.exp(enter[i, :outside] + value - total)
                for f in segments[k][2]:
                    g_weights[f] -= share
            g_follow -= np.exp(alpha[i][:, None] + self.follow + ahead[None, :] - total)
            beta[i] = lse(self.follow + ahead[None, :], axis=1)
        was, at, chosen = outside, 0, {(i, j): y for i, j, y in gold}
        feats = {(i, j): f for i, j, f in segments}
        begin = {i: (j, y) for (i, j), y in chosen.items()}
        while at < n:
            j, y = begin.get(at, (at + 1, outside))
            g_follow[was, y] += 1
            if y != outside:
                for f in feats[at, j]:
                    g_weights[f, y] += 1
            was, at = y, j


def _sentences(n: int, seed: int):
    """(text, [(start, end, kind)]) for training; made from a seed."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(("ba", "re", "ti", "on", "er", "sch", "que", "lo", "an", "th")) for _ in range(r.randint(1, 4)))

    def card(size=16):
        d = r.choice("3456") + digits(size - 2)
        d += next(c for c in "0123456789" if luhn(d + c))
        return d if r.random() < 0.6 else r.choice(" -").join(d[k : k + 4] for k in range(0, size, 4))

    def not_card():
        d = digits(16)
        return d if not luhn(d) else d[:-1] + str((int(d[-1]) + 5) % 10)

    def spelt():
        at, dot = r.choice(((" at ", " dot "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "."), (" (at) ", " (dot) "), (" @ ", ".")))
        return f"{word()}{r.choice(('', '.' + digits(2), dot + word()))}{at}{word()}{dot}{r.choice(('com', 'org', 'net', 'de', 'example' + dot + 'com'))}"

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}", f"0{digits(2)} {digits(4)} {digits(4)}", f"{b}-{c}", f"1 ({a}) {b}-{c}"))

    entities = {
        0: spelt,
        1: lambda: ".".join(str(r.randint(1, 254)) for _ in range(4)),
        2: card,
        3: phone,
        4: lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice((32, 40, 40, 64)))) if r.random() < 0.7 else "".join(r.choice("abcdefghijkXYZ0123456789") for _ in range(r.randint(24, 40))) + "7",
        5: lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
    }
    cues = {0: ("email", "mail", "write to"), 1: ("ip", "host"), 2: ("card", "visa"), 3: ("phone", "tel", "call"), 4: ("token =", "key:", "secret"), 5: ("ssn", "social security")}
    decoys = (
        lambda: f"version {r.randint(1, 9)}.{r.randint(0, 9)}", lambda: f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}",
        lambda: f"${digits(3)},{digits(3)}.{digits(2)}", not_card, lambda: f"{digits(2)}:{digits(2)}", lambda: f"ISBN 978-{digits(1)}-{digits(3)}-{digits(5)}-{digits(1)}",
        lambda: digits(r.randint(7, 12)), lambda: f"{digits(3)}.{digits(7)}", lambda: f"{r.randint(256, 999)}.{digits(3)}.{digits(3)}.{digits(3)}", lambda: f"{digits(5)}-{digits(4)}", lambda: f"{r.randint(1990, 2020)} {r.randint(1990, 2020)}",
        lambda: f"at {word()} dot", lambda: f"@{word()}", lambda: f"{digits(9)}{word()}", lambda: f"{r.randint(1, 28)}/{r.randint(10, 12)}/{r.randint(1990, 2020)}", lambda: f"{digits(13)}", lambda: f"commit {''.join(r.choice('0123456789abcdef') for _ in range(7))}",
    )
    for _ in range(n):
        text, spans = " ".join(word() for _ in range(r.randint(1, 3))), []
        for _ in range(r.randint(1, 3)):
            text += " "
            if r.random() < 0.62:
                kind = r.randrange(len(KINDS))
                cued = r.random() < (0.95 if kind == 4 else 0.9 if kind == 5 else 0.4)
                text += r.choice(cues[kind]) + " " if cued else word() + " "
                quote = '"' if kind == 4 and r.random() < 0.7 else ""
                value = entities[kind]()
                spans.append((len(text + quote), len(text + quote + value), kind))
                text += quote + value + quote
                if kind == 2 and r.random() < 0.3:  # two numbers side by side
                    spans.append((len(text) + 1, len(text) + 1 + len(value := card()), kind))
                    text += " " + value
            else:
                text += r.choice(decoys)()
            text += r.choice(("", "", "", ".", ",", "***", "!!", "$$$", " |")) + " " + " ".join(word() for _ in range(r.randint(1, 3)))
        yield text, spans


@lru_cache(maxsize=1)
def trained(sentences: int = 320, rounds: int = 12, seed: int = 7) -> Field:
    """The field; the same on every run."""
    field, made = Field(), []
    for text, spans in _sentences(sentences, seed):
        tokens, segments = lattice(text, 0, len(text), [])
        at = {(tokens[i][0], tokens[j - 1][1]): (i, j) for i, j, _ in segments}
        gold = {(*at[a, b], kind) for a, b, kind in spans if (a, b) in at}
        for _, _, names in segments:
            for name in names:
                field.index.setdefault(name, len(field.index))
        made.append((len(tokens), [(i, j, field.known(names)) for i, j, names in segments], gold))
    field.weights = np.zeros((len(field.index), len(KINDS)))
    sums = [np.full_like(x, 1e-2) for x in (field.weights, field.follow)]
    order = list(range(len(made)))
    r = random.Random(seed)
    for _ in range(rounds):
        r.shuffle(order)
        for k in range(0, len(order), 16):
            grads = [-0.02 * field.weights, -0.02 * field.follow]
            for m in order[k : k + 16]:
                field.gradient(*made[m], *grads)
            for x, g, s in zip((field.weights, field.follow), grads, sums, strict=True):
                s += g * g
                x += 0.5 * g / np.sqrt(s)
    return field


def find_spans(text: str, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and those that the field adds (none overlaps a base span)."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    flat: list[list[int]] = []
    for a, b in taken:
        if flat and a < flat[-1][1]:
            flat[-1][1] = max(b, flat[-1][1])
        else:
            flat.append([a, b])
    solid = [(a, b) for a, b in flat]
    added = []
    for a, b in regions(text):
        tokens = Tokens(text, a, b)
        chosen = field.decode_from(len(tokens), lambda i: starting(text, tokens, i, solid))  # noqa: B023  used at once
        added += [(KINDS[y], tokens[i][0], tokens[j - 1][1]) for i, j, y in chosen]
    return base, added


def _listed(spans: list[tuple[str, int, int]]) -> str:
    rank = {k: n for n, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (rank[s[0]], s[1], s[2])))


_FOUND = pa.schema([("doc_id", pa.int64()), ("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()), ("n_phone", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def _find(model):
    def run(batches):
        field = model.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), common.text_values(batch.column("text")), strict=True):
                base, added = find_spans(text, field)
                n = [sum(k == kind for k, _, _ in base) for kind in KINDS[:4]]
                rows.append((doc, *n, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(base + added)))
            if rows:
                yield common.batch_of(_FOUND, zip(*rows, strict=True))

    return run


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of base spans, and all spans of every row; a null text is empty.

    Offsets count code points.  Rows that share a doc_id, or are equal, are searched
    each; an empty table gives no rows; other columns are not read.  A long text of nothing
    but digits takes time and memory in proportion to its length.
    """
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    model = spark.sparkContext.broadcast(trained())
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_find(model), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, field: Field) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans as one."""
    base, added = find_spans(text, field)
    out, at = [], 0
    for kind, a, b in sorted(base + added, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out.append(text[at:a] + f"[{kind.upper()}]")
        at = max(at, b)
    return "".join(out) + text[at:]


def _redact(model):
    def run(batches):
        common.leave_memory()
        field = model.value
        for batch in batches:
            texts = [t if t is None else redact(t, field) for t in batch.column("text").to_pylist()]
            rest = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], names=batch.schema.names)

    return run


def redact_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; n_chars, if there, is the new length; null texts stay null.

    Every row stays, with all its other columns whatever their names; an empty table stays
    empty.  Long texts take time and memory in proportion to their length.
    """
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    model = spark.sparkContext.broadcast(trained())
    names = [c for c in docs.columns if c != "text"]
    moved = docs.select(*(F.col(f"`{c}`") for c in names), F.col("text").cast("string").alias("text"))
    spec = StructType([StructField(f.name, f.dataType, True) for f in moved.schema.fields])
    done = moved.mapInArrow(_redact(model), spec)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return done.select(*(F.col(f"`{c}`") for c in docs.columns))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: base counts and digest, and all spans."""
    return find(common.read_table(spark, sf_dir, "documents"))
