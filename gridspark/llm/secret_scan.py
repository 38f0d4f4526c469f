"""Secrets in texts: three fixed patterns, and a linear-chain conditional random field for others.

The field tags tokens as secret begin, inside or outside (B, I, O). Tokens are runs of value
characters. Where no line names logins or passwords, plain ones (short, or letters without a
digit, and beside no secret word or assignment mark) can only be outside, so the best path splits
at them and is decoded by Viterbi over each run of other tokens; of a line that names these all
tokens are tagged. Features are of shapes, the words and marks beside a token, whether the
sampled documents hold it as a word, and its file. It is trained in numpy on a
bounded sample of documents: what the patterns find there is secret, and secrets of other
kinds and harmless numbers and words are written into them.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import sampled, slices
from gridspark.llm.text_hash import LOWER, bytes_of, runs

# The patterns, the fewest characters of a secret in each, and their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # runs of [0-9a-f] of 24 characters or more
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "crf")
#: Words that every match of ASSIGN holds.
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_VALUE = np.zeros(256, bool)
_VALUE[[c for c in range(128) if chr(c).isalnum() or chr(c) in "+/_.=-"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HEX = np.zeros(256, bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True
_MARK = np.zeros(256, bool)
_MARK[[58, 61]] = True  # : and =
#: Tokens that can be secret wherever they stand: so many characters with a digit, or so many of any.
SHORT, LONG = 8, 24
#: Documents sampled for training, about; epochs.
SAMPLE, EPOCHS = 300, 12
#: Words of the sampled documents that a model knows at most.
WORDS = 20_000
_NEAR = re.compile(r"pass|pwd|secret|token|key|auth|bearer|credential|private|jwt|sig", re.I)
_TAGS = "OBI"
#: Marks between a login and its password.
_PARTS = frozenset("/|:=,")
#: A value beside a word that names secrets or after an assignment mark, password characters included.
_NAMED = r"(?:pass(?:words?|wd|phrase|code|wort)?|(?<![a-z])pw|pwd|secrets?|tokens?|keys?|auth|bearer|credentials?|private|jwt|sig|signature)"
_STRONG = re.compile(r"(?:passwords?|passwd|passphrase|passcode|passwort|(?<![a-z])pw|pwd|secrets?|credentials?)[^A-Za-z]*$", re.I)
_IS = re.compile(r"\b(?:is|was)\s+[\"']?$")
_NAMES_SECRET = re.compile(rf"{_NAMED}[0-9_-]{{0,4}}[\"']?\s{{0,3}}$", re.I)
_PASSWORD = r"[\w+/.=@!#$%&*^~?-]+"
#: The password in an address: it ends at the mark before the host.
_USERINFO = re.compile(r"://[^\s/@:\"'<>]*:([^\s/@\"'<>]+)@")
#: Words that make all tokens of their line worth a look; the same in bytes of lower case.
_LINE_WORDS = r"(?<![a-z])(?:log-?in|logon|username|pass(?:word|wd|phrase|code|wort)|pwd?|credential|secret)s?(?![a-z])"
_NAMES_LINE, _NAMES_LINE_BYTES = re.compile(_LINE_WORDS, re.I | re.A), re.compile(_LINE_WORDS.encode())
_IN_LINE = re.compile(r"[\w+/.@!#$%&*^~?-]{3,}")
_SAID_AFTER = re.compile(rf"\s{{1,3}}(?:is|was)\s{{1,3}}(?:my|our|your|the|his|her|their)\s{{1,3}}(?:\w{{1,20}}\s{{1,3}})?{_LINE_WORDS}", re.I | re.A)
_PLACED = re.compile(rf"[:=]>?[\"'\x20]{{0,4}}({_PASSWORD})")
#: After such a name and a verb any value can be secret, plain letters too.
_TOLD = re.compile(rf"(?:passwords?|passwd|passphrase|passcode|passwort|pwd|secrets?|credentials?)\x20+(?:is|was)\x20+[\"']?({_PASSWORD})", re.I)
_SAID = re.compile(rf"{_NAMED}(?:\x20+(?:is|was))?\x20+[\"']?({_PASSWORD})", re.I)
#: What _SAID needs, in bytes of lower case; assignment marks are found one by one.
_SAID_WORDS = re.compile(rb"(?:pass(?:word|wd|phrase|code|wort)?|pwd|secret|token|key|auth|bearer|credential|private|jwt|sig|signature)s?(?: +(?:is|was))? ")


def _runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True within texts."""
    n = len(mask)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = mask[:-1]
    after = np.zeros(n, bool)
    after[:-1] = mask[1:]
    return np.flatnonzero(mask & (~before | cut[:n])), np.flatnonzero(mask & (~after | cut[1:])) + 1


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of what the patterns match, by start and kind."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if m.end() - m.start() >= LEAST[kind]]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def _shown(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


@dataclass
class Token:
    start: int
    end: int
    features: list[str] = field(default_factory=list)


def _shape(value: str) -> list[str]:
    n, kinds = len(value), Counter("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else c for c in value)
    counts = Counter(value).values()
    entropy = -sum(k / n * math.log2(k / n) for k in counts)
    digits = kinds["d"] / n
    marks = "".join(sorted(k for k in kinds if k not in "dul"))
    out = ["bias", f"length {min(n // 4, 12)}", f"entropy {int(entropy * 2)}", f"digits {int(digits * 5)}", f"classes {''.join(k for k in 'dul' if kinds[k])}", f"marks {marks}"]
    if re.fullmatch(r"[0-9.+/_=-]+", value):
        out.append("number")
    if re.fullmatch(r"[A-Za-z]+[0-9]{0,4}[.=]?", value):
        out.append("word")
    if re.fullmatch(r"[0-9a-fA-F]{16,}", value):
        out.append("hex")
    if re.match(r"(gh[pousr]_|sk-|pk_|sk_|xox|eyJ|AKIA|ASIA|glpat-|AIza|npm_)", value):
        out.append("prefix")
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))
    out.append(f"changes {min(int(8 * changes / n), 5)}")
    if "/" in value and re.fullmatch(r"[A-Za-z0-9._/-]+", value) and max(map(len, re.split(r"[/._-]", value))) < 16:
        out.append("path")
    return out


def sequences(text: str, at: list[tuple[int, int]], vocabulary: frozenset[str] = frozenset()) -> list[list[Token]]:
    """The candidate tokens at these places, in runs between which plain words stand, with features. vocabulary: words that documents hold."""
    file = [f"file numbers {min(len(at).bit_length(), 6)}", f"file names secrets {bool(_NEAR.search(text))}"]
    out: list[list[Token]] = []
    last = -1
    for a, b in at:
        while b - a > 1 and text[b - 1] in ".=-?":
            b -= 1
        before, after = text[max(0, a - 40) : a], text[b : b + 2]
        gap = text[last:a] if last >= 0 else "x"
        features = [*_shape(text[a:b]), *file]
        mark = re.search(r"[:=\"'(<,;@#$%&*!?]+\s*$", before)
        features.append(f"mark before {mark[0].strip()[-2:] if mark else 'no'}")
        words = re.findall(r"[A-Za-z_]+", before)
        features.append(f"word before {bool(words and _NEAR.search(words[-1]))}")
        features.append(f"names secret {bool(_STRONG.search(before))} {bool(mark)}")
        features.append(f"told {bool(_IS.search(before))} known {text[a:b].lower() in vocabulary} letters {text[a:b].isalpha()}")
        said, login = bool(_SAID_AFTER.match(text, b)), bool(_NAMES_LINE.search(before))
        features.append(f"said after {said} known {text[a:b].lower() in vocabulary} letters {text[a:b].isalpha()} long {b - a >= 12}")
        features.append(f"login before {login} parted {before.rstrip()[-1:] in _PARTS} mixed {_mixed(text[a:b])}")
        features.append(f"address {after[:1] == '@' and bool(re.search(r'://[^/@:]*:$', before))}")
        features.append(f"words before {any(_NEAR.search(x) for x in words[-3:-1])}")
        features.append(f"after {after[:1]}" if after[:1] in {'"', "'", ",", ";", ")"} else "after else")
        if any(c.isalpha() for c in gap):
            out.append([])
        out[-1].append(Token(a, b, features))
        last = b
    return out


@dataclass
class Field:
    """Weights of (feature, tag) and of (tag, next tag); I can't follow O or stand first."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    moves: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))
    vocabulary: frozenset[str] = frozenset()

    def scores(self, tokens: list[Token]) -> np.ndarray:
        zero = np.zeros(3)
        return np.array([sum((self.weights.get(f, zero) for f in t.features), zero) for t in tokens])

    def viterbi(self, tokens: list[Token]) -> str:
        scores = self.scores(tokens)
        best, back = scores[0] + [0, 0, -np.inf], []
        for s in scores[1:]:
            step = best[:, None] + self.moves + _FORBIDDEN
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + s
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return "".join(_TAGS[i] for i in reversed(path))

    def train(self, data: list[tuple[list[Token], str]], epochs: int = EPOCHS, seed: int = 3) -> Field:
        """Stochastic gradient descent on the paths' likelihood, with weight decay."""
        rng = np.random.default_rng(seed)
        number: dict[str, int] = {}
        rows = []
        for tokens, tags in data:
            of = [[number.setdefault(f, len(number)) for f in t.features] for t in tokens]
            sizes = np.array([len(x) for x in of])
            rows.append((np.concatenate(of).astype(np.int64), np.cumsum(sizes) - sizes, np.repeat(np.arange(len(of)), sizes), [_TAGS.index(t) for t in tags]))
        table = np.zeros((len(number), 3))
        for epoch in range(epochs):
            rate = 0.3 / (1 + epoch)
            for i in rng.permutation(len(rows)):
                features, first, of, gold = rows[i]
                values = table[features]
                single, pairs = marginals(np.add.reduceat(values, first), self.moves)
                step = -rate * single
                step[np.arange(len(gold)), gold] += rate
                change = step[of] - rate * 0.002 * values
                if len(gold) == 1:
                    table[features] += change
                    continue
                np.add.at(table, features, change)
                self.moves -= rate * pairs
                np.add.at(self.moves, (gold[:-1], gold[1:]), rate)
        self.weights = {f: table[i] for f, i in number.items()}
        return self


def marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token's tag, and sums over neighbours of each pair of tags: forward and backward, scaled at each token."""
    own = np.exp(scores - scores.max(axis=1, keepdims=True))
    if len(own) == 1:
        own[0, 2] = 0
        return own / own.sum(), np.zeros((3, 3))
    step = np.exp(moves - moves.max() + _FORBIDDEN)
    own[0, 2] = 0
    n = len(own)
    forth, back, scale = np.empty((n, 3)), np.ones((n, 3)), np.empty(n)
    at = own[0]
    for i in range(n):
        at = at if i == 0 else (at @ step) * own[i]
        scale[i] = at.sum()
        forth[i] = at = at / scale[i]
    at = back[-1]
    for i in range(n - 1, 0, -1):
        back[i - 1] = at = step @ (own[i] * at) / scale[i]
    pairs = (forth[:-1].T @ (own[1:] * back[1:] / scale[1:, None])) * step
    return forth * back, pairs


_FORBIDDEN = np.zeros((3, 3))
_FORBIDDEN[0, 2] = -np.inf


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of value characters, in code points, that can be secret, and values beside secret words and marks."""
    return with_placed(text, [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", text) if _can_be_secret(m[0])])


def placed(text: str) -> list[tuple[int, int]]:
    """Values that can be secret because of where they stand.

    After a secret word and a mark, or a word for passwords and "is" or "was", any value; after the
    word alone or another mark one that mixes letters with digits or password characters.
    """
    found = [(m.start(1), m.end(1)) for m in _USERINFO.finditer(text)]
    within = {a for a, _ in found}
    for m in _PLACED.finditer(text):
        if m.start(1) in within:
            continue
        if _NAMES_SECRET.search(text, max(0, m.start() - 24), m.start()) or _mixed(m[1]):
            found.append((m.start(1), m.end(1)))
    found += [(m.start(1), m.end(1)) for m in _TOLD.finditer(text)]
    return found + [(m.start(1), m.end(1)) for m in _SAID.finditer(text) if _mixed(m[1])]


def in_lines(text: str) -> Iterator[tuple[int, int]]:
    """Tokens of the lines that name logins or passwords, but for these names."""
    done = 0
    for m in _NAMES_LINE.finditer(text):
        if m.start() < done:
            continue
        start = text.rfind("\n", 0, m.start()) + 1
        done = text.find("\n", m.end())
        done = len(text) if done < 0 else done
        for t in _IN_LINE.finditer(text, start, done):
            if not (_NEAR.search(t[0]) or _NAMES_LINE.search(t[0])) or any(map(str.isdigit, t[0])):
                yield t.start(), t.end()


def _mixed(value: str) -> bool:
    value = value.rstrip(".=-!?")
    return len(value) >= 4 and any(map(str.isalpha, value)) and any(c.isdigit() or c in "@!#$%&*^~?" for c in value) and not value.startswith("//")


def with_placed(text: str, at: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """at, the placed values and the tokens of lines that name secrets.

    Where at and a placed value overlap, one candidate goes from the placed value's start to the
    later end; a token of a line gives way to a placed value and is joined with others.
    """
    out: list[tuple[int, int]] = []
    more = {}
    for a, b in placed(text):
        more[a] = max(b, more.get(a, b))
    starts, rest = sorted(more), []
    for a, b in at:
        i = bisect_right(starts, a)
        if i and more[starts[i - 1]] > a:  # begins within a placed value
            more[starts[i - 1]] = max(more[starts[i - 1]], b)
        elif i < len(starts) and starts[i] < b:  # a name and its mark lead to the value
            more[starts[i]] = max(more[starts[i]], b)
        else:
            rest.append((a, b))
    for a, b in in_lines(text):
        i = bisect_right(starts, a)
        if not (i and more[starts[i - 1]] > a or i < len(starts) and starts[i] < b):
            rest.append((a, b))
    for a, b in sorted([*more.items(), *rest]):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _can_be_secret(value: str) -> bool:
    return len(value) >= LONG or len(value) >= SHORT and any(c.isdigit() for c in value)


def _written_secret(rng: np.random.Generator) -> list[str]:
    """A secret as it stands in files; its lines, of which there are several for a key."""
    pick = lambda chars, n: "".join(chars[i] for i in rng.integers(0, len(chars), n))
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    kind = int(rng.integers(0, 6))
    if kind == 0:
        return [f"ghp_{pick(lower + upper + digits, 36)}"]
    if kind == 1:
        return [f"sk-{pick(lower + upper + digits, int(rng.integers(24, 49)))}"]
    if kind == 2:
        return [f"Bearer {pick(lower + upper + digits, 10)}7{pick(lower + upper + digits + '-_', int(rng.integers(20, 60)))}"]
    if kind == 3:
        return [f"eyJhbGciOiJIUzI1NiJ9.{pick(lower + upper + digits, 40)}.{pick(lower + upper + digits, 43)}"]
    if kind == 4:
        return [f"{('pwd', 'auth', 'credential', 'private key')[int(rng.integers(0, 4))]}: {pick(lower + upper + digits, 5)}9{pick(lower + upper + digits, int(rng.integers(6, 20)))}"]
    body = base64.b64encode(rng.bytes(144)).decode()
    return ["-----BEGIN PRIVATE KEY-----", *(body[i : i + 64] for i in range(0, len(body), 64)), "-----END PRIVATE KEY-----"]


def _harmless(rng: np.random.Generator) -> str:
    n = lambda a, b: int(rng.integers(a, b))
    return (f"{n(1900, 2030)}-{n(10, 13)}-{n(10, 29)}", f"+{n(1, 99)}-{n(200, 999)}-{n(1000, 9999)}-{n(100, 999)}", f"{n(1, 255)}.{n(1, 255)}.{n(100, 255)}.{n(10, 255)}", f"{n(10**15, 10**16 - 1)}", f"version-{n(1, 30)}.{n(0, 20)}.{n(100, 999)}", f"user{n(10, 9999)}.name", f"www.example{n(1, 99)}.org/page/{n(1, 999)}", f"data/part-{n(10000, 99999)}.parquet", f"chapter_{n(1, 40)}_section_{n(1, 99)}", f"{n(10**8, 10**10)}")[n(0, 10)]


def _written_password(rng: np.random.Generator, words: list[str]) -> tuple[str, str, str]:
    """What leads to a password, a password (short, of letters, or with other characters), and what follows it."""
    pick = lambda x: x[int(rng.integers(0, len(x)))]
    letters = lambda n: "".join(chr(97 + int(i)) for i in rng.integers(0, 26, n))
    word = lambda: re.sub(r"[^A-Za-z]", "", pick(words)) or letters(5)
    n, mark = int(rng.integers(1, 10000)), pick("@!#$%&*")
    value = pick((
        f"{word()}{mark}{n}",
        f"{mark}{word().capitalize()}{n}{pick('!#$')}",
        f"P{mark}ss{letters(3)}{n}",
        f"{word().lower()}{word().lower()}{word().lower()}",
        f"{letters(3)}{n % 100}",
        f"{letters(2)}{mark}{letters(3)}{n}",
        f"{pick('äöüßéñ')}{word()}{n}",
        letters(int(rng.integers(5, 14))),
    ))
    strong = pick(("password", "pwd", "pw", "Password", "passwd", "db_password", "passphrase", "secret", "credential"))
    weak = pick(("auth", "token", "key", "api key"))
    plain, user = value.isalpha(), pick(("admin", "root", word().lower(), f"{word().lower()}{n % 100}"))
    way = int(rng.integers(0, 10))
    if way == 0 and not plain:
        return f"{pick(('postgres', 'mysql', 'https', 'ftp', 'amqp'))}://{user}:", value.replace("@", "%"), f"@{word().lower()}.example.{pick(('com', 'org', 'net'))}{pick(('', '/data', ':5432'))}"
    if way == 1 and not plain:
        return f"{pick(('login', 'Login', 'username', 'logon'))}{pick((': ', '=', ' '))}{user}{pick((' / ', ' | ', ', ', ' : '))}", value, ""
    if way == 2:
        value = f"{word().lower()}{word().lower()}{word().lower()}{letters(3)}" if plain else value
        return "", value, f" {pick(('is', 'was'))} {pick(('my', 'our', 'the'))} {pick(('login', 'password', 'passphrase', 'secret', 'pw'))}"
    lead = pick((f"{strong}: ", f"{strong}=", f"{strong} = ", f'{strong}: "', f"{strong} is ", f"{strong} was ", *(() if plain else (f"{weak}: ", f"{weak}=", f"the {strong} "))))
    return lead, value, ""


def _harmless_value(rng: np.random.Generator, words: list[str]) -> str:
    """A value after a mark or a secret word that is none."""
    pick = lambda x: x[int(rng.integers(0, len(x)))]
    n, word = int(rng.integers(1, 1000)), pick(words)
    word, strong = re.sub(r"[^A-Za-z]", "", word) or word, pick(("password", "secret", "passphrase", "credential"))
    return pick((f"the {strong} is {word}", f"{strong} was {word}", f"a {strong} is {word}", f"key: {word}", f"the key = {n}", f"note: {word}", f"size: {n}px", f"width={n}", f"x={n}a{n}", f"at {n % 24}:{n % 60:02d}pm", f"see: chapter{n}", f"a key {word}", f"token {n}", f"tokens: {n}", f"ratio: {n}%", f"mail: {word}@example.org", f"https://example.org/{word}{n}", f"author: {word}{n % 10}", f"monkey: {word}", f"version: v{n}", f"id=item{n}", f"private: {word}", f"sig: {n}", f"login: {word} / {word.lower()}", f"{word} is my login", f"{word} was the {strong}", f"the login of {word} at {n % 24}:{n % 60:02d}", f"username {word} and {word}", f"https://example.org:{8000 + n}/{word}@{n}"))


def fit(texts: list[str], seed: int = 9) -> Field:
    """Trains on these texts, with secrets and harmless numbers written into copies of them."""
    rng = np.random.default_rng(seed)
    texts = texts or ["the one and the other"]
    data = []
    counts = Counter(w for x in texts for w in {w.strip(_BARE).lower() for w in x.split()})
    known = frozenset(w for w, n in counts.most_common(WORDS) if n > 1)

    def learn(text: str, secrets: list[tuple[int, int]]) -> None:
        for tokens in sequences(text, candidates(text), known):
            tags, inside = "", -1
            for t in tokens:
                own = next((i for i, (a, b) in enumerate(secrets) if a <= t.start < b), -1)
                tags += "O" if own < 0 else "I" if own == inside else "B"
                inside = own
            data.append((tokens, tags))

    for text in texts:
        learn(text, [(a, b) for a, _, b in base_spans(text)])
    for k in range(4 * SAMPLE):
        words = texts[k % len(texts)].split(" ")
        a = int(rng.integers(0, len(words)))
        head, tail = " ".join(words[a : a + int(rng.integers(1, 12))]), " ".join(words[: int(rng.integers(1, 12))])
        if k % 2:
            lines = _written_secret(rng)
            text = f"{head} {chr(10).join(lines)} {tail}"
            start = len(head) + 1
            added = [(start, start + len("\n".join(lines)))]
        else:
            text, added = f"{head} {_harmless(rng)} {tail}", []
        learn(text, added + [(a, b) for a, _, b in base_spans(text) if not any(c <= a < d for c, d in added)])
    vocabulary = [w for x in texts[:100] for w in x.split()[:50]] or ["the"]
    for k in range(6 * SAMPLE):
        words = texts[k % len(texts)].split(" ")
        a = int(rng.integers(0, len(words)))
        head, tail = " ".join(words[a : a + int(rng.integers(1, 12))]), " ".join(words[: int(rng.integers(1, 12))])
        if k % 2:
            lead, value, trail = _written_password(rng, vocabulary)
            start = len(head) + 1 + len(lead)
            text, added = f"{head} {lead}{value}{trail} {tail}", [(start, start + len(value))]
        else:
            text, added = f"{head} {_harmless_value(rng, vocabulary)} {tail}", []
        learn(text, added + [(a, b) for a, _, b in base_spans(text) if not any(c < b and a < d for c, d in added)])
    return Field(vocabulary=known).train(data)


def sample(docs: DataFrame, n: int = SAMPLE) -> list[str]:
    """Texts of about n documents, at most 2 n."""
    return sampled(docs, "doc_id", "text", n)


def added_spans(model: Field, text: str, at: list[tuple[int, int]], base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """What the field tags as secret beside the patterns' spans."""
    found = []
    for tokens in sequences(text, at, model.vocabulary):
        tags = model.viterbi(tokens)
        for t, tag in zip(tokens, tags):
            if tag == "I":
                found[-1][2] = t.end
            elif tag == "B":
                found.append([t.start, "crf", t.end])
    return [(a, kind, b) for start, kind, end in found for a, b in _left(text, start, end, base)]


#: Names with their mark, and quotes and marks alone, are no part of a secret.
_LABEL = re.compile(r"[A-Za-z_.-]*[A-Za-z][A-Za-z0-9_.-]*[:=]+")
_BARE = "\"' \t\r\n.=:,;-"


def _left(text: str, start: int, end: int, base: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """What the patterns' spans leave of a span: all of it, or its parts beside them that say something."""
    over = sorted((a, b) for a, _, b in base if a < end and start < b)
    if not over:
        return [(start, end)]
    parts, at = [], start
    for a, b in [*over, (end, end)]:
        if at < a:
            parts.append((at, a))
        at = max(at, b)
    out = []
    for a, b in parts:
        while a < b and text[a] in _BARE:
            a += 1
        while a < b and text[b - 1] in _BARE and not _LABEL.fullmatch(text, a, b):
            b -= 1
        if a < b and not _LABEL.fullmatch(text, a, b):
            out.append((a, b))
    return out


def scan_texts(model: Field, column: pa.Array) -> Iterator[tuple[list, list]]:
    """(base spans, all spans) of each text, in order. Only texts that hold a place worth a look are decoded."""
    data, offsets = bytes_of(column)
    for a, b in runs(offsets):
        raw = data[offsets[a] : offsets[b]]
        own = offsets[a : b + 1] - offsets[a]
        look = np.zeros(b - a, bool)
        low, same = LOWER[raw].tobytes(), raw.tobytes()
        for where, words in ((low, _WORDS), (same, (b"AKIA",))):
            for word in words:
                i = where.find(word)
                while i >= 0:
                    d = bisect_right(own, i) - 1
                    look[d] = True
                    i = where.find(word, max(i + 1, int(own[d + 1])))  # on in the next text
        start, end = _runs(_HEX[raw], own)
        look[np.searchsorted(own, start[end - start >= LEAST["hex"]], side="right") - 1] = True
        start, end = _runs(_VALUE[raw], own)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[raw], dtype=np.int64)])
        size = end - start
        can = (size >= LONG) | (size >= SHORT) & (digits[end] > digits[start])
        start, end = start[can], end[can]
        first = np.searchsorted(start, own)
        look |= np.diff(first) > 0
        near = np.zeros(b - a, bool)  # a mark that a value may follow, or a secret word before one
        near[np.searchsorted(own, np.flatnonzero(_MARK[raw]), side="right") - 1] = True
        for words in (_SAID_WORDS, _NAMES_LINE_BYTES):
            near[np.searchsorted(own, np.array([m.start() for m in words.finditer(low)], np.int64), side="right") - 1] = True
        look |= near
        for d in range(b - a):
            if not look[d]:
                yield [], []
                continue
            chunk = raw[own[d] : own[d + 1]]
            text = chunk.tobytes().decode()
            s, e = start[first[d] : first[d + 1]] - own[d], end[first[d] : first[d + 1]] - own[d]
            if len(text) != len(chunk):
                lead = np.concatenate([[0], np.cumsum((chunk & 0xC0) != 0x80)])
                s, e = lead[s], lead[e]
            base = base_spans(text)
            at = list(zip(s.tolist(), e.tolist()))
            at = with_placed(text, at) if near[d] else at
            more = added_spans(model, text, at, base) if at else []
            yield base, sorted(base + more, key=lambda x: (x[0], KINDS.index(x[1])))


def find_secrets(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """One row a row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points of the whole text, end exclusive, by start and kind,
    joined by commas: those of the patterns, and as kind crf what the field adds beside them. base_sha256 is the digest of the patterns' spans alone. Null and empty
    texts have no spans. Repeated rows are scanned each; other columns are not read; an empty
    table gives no rows. The model is trained on a bounded sample of docs unless one is given.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    model = docs.sparkSession.sparkContext.broadcast(model or fit(sample(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, spans in scan_texts(model.value, batch.column("text")):
                n = Counter(kind for _, kind, _ in base)
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_shown(base).encode()).hexdigest(), _shown(spans)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [*[pa.int64()] * 3, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(columns, kinds))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, str, int]], mark: str = "[SECRET]") -> str:
    """text with a mark in place of each stretch that spans cover."""
    out, last = [], 0
    for a, _, b in sorted(spans):
        if a >= last:
            out += [text[last:a], mark]
        last = max(last, b)
    return "".join(out) + text[last:]


def redact_secrets(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """docs with every secret in text replaced by [SECRET] and n_chars, if there, counted again; no row goes."""
    model = docs.sparkSession.sparkContext.broadcast(model or fit(sample(docs)))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            names = batch.schema.names
            changed = [(i, spans) for i, (_, spans) in enumerate(scan_texts(model.value, batch.column("text"))) if spans]
            if changed:
                texts = batch.column("text").to_pylist()
                for i, spans in changed:
                    texts[i] = redact(texts[i], spans)
                at = names.index("text")
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if "n_chars" in names:
                    at = names.index("n_chars")
                    counts = batch.column("n_chars").to_pylist()
                    for i, _ in changed:
                        counts[i] = len(texts[i])
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(counts, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, schema)
