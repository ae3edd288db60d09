"""Secret scan: base patterns, and a token-efficiency test for random strings.

Random strings cost many tokens: under a byte-level vocabulary, prose and names take three or more characters a token,
keys and passwords hardly two. A run of key characters is cut at separators, so that words of a path or a name beside a key
don't hide it; parts whose characters per token stay at or below a ratio are random, and neighbouring ones make a stretch,
which is reported if it is long enough. Known digests and identifiers are left out.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass
from hashlib import sha256

import tiktoken
from pyspark.sql import DataFrame

from boxlake.llm.common import map_text, vocabulary

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: One of these stands in any text that the first pattern matches.
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PART = re.compile(r"[A-Za-z0-9]+")
#: Known digests (by length in hex characters: md5, sha-1, sha-224, sha-256, sha-384, sha-512), and identifiers by groups.
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
DIGEST_SIZES = frozenset((32, 40, 56, 64, 96, 128))
IDENTIFIER = re.compile(r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9a-fA-F])")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KINDS = ("assign", "access", "hex", "random")


@dataclass(frozen=True)
class Policy:
    """Most characters per token of a random part: ``ratio`` where it mixes kinds of characters, ``lower`` and ``upper`` where it
    is letters of one case; ``least``: letters and digits of a random string; ``part``: least length of a part that is tested."""

    ratio: float = 2.0
    lower: float = 1.9
    upper: float = 1.75
    least: int = 16
    part: int = 8


def mixed(part: str) -> bool:
    """Whether letters of both cases, or letters and digits, meet; a capital at the start alone is no other case."""
    letters = part[1:] if part[0].isupper() and part[1:2].islower() else part
    return any(c.islower() for c in letters) + any(c.isupper() for c in letters) + any(c.isdigit() for c in letters) >= 2


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by the base patterns: leftmost, non-overlapping within a kind; failing matches drop out."""
    out = []
    low = text.lower() if text.isascii() else text.translate(_LOWER)
    if any(h in low for h in HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


_LOWER = {c: c + 32 for c in range(65, 91)}


class Scanner:
    """Built once for each task."""

    def __init__(self, data: bytes, policy: Policy) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.policy = policy

    def parts(self, run: str, start: int):
        """(start, end, what) of the pieces of a run between separators; what: 'random', 'odd' (too short to tell) or 'plain'."""
        for m in PART.finditer(run):
            part = m[0]
            several = mixed(part)
            if len(part) < self.policy.part:
                what = "odd" if several else "plain"
            elif len(part) in DIGEST_SIZES and DIGEST.fullmatch(part) or not several and (len(part) < self.policy.least or part.isdigit()):
                what = "plain"
            else:
                most = self.policy.ratio if several else self.policy.upper if part.isupper() else self.policy.lower
                what = "random" if len(part) <= most * len(self.encoding.encode_ordinary(part)) else "plain"
            yield start + m.start(), start + m.end(), what

    def random_spans(self, text: str) -> list[tuple[int, int, str]]:
        """Stretches of random parts of key-like runs, with the odd ones beside them, of ``least`` letters and digits at least."""
        out = []
        for run in RUN.finditer(text):
            a = run.start()
            for known in [*IDENTIFIER.finditer(run[0]), None]:
                b = run.start() + known.start() if known else run.end()
                stretch: list[tuple[int, int, str]] = []
                for part in [*self.parts(text[a:b], a), (b, b, "plain")]:
                    if part[2] != "plain":
                        stretch.append(part)
                        continue
                    if sum(y - x for x, y, _ in stretch) >= self.policy.least and any(w == "random" for *_, w in stretch):
                        out.append((stretch[0][0], stretch[-1][1], "random"))
                    stretch = []
                a = run.start() + known.end() if known else b
        return out

    def scan(self, text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Base spans and all spans, by start, then kind as listed."""
        if not text:
            return [], []
        order = lambda s: (s[0], KINDS.index(s[2]), s[1])
        base = sorted(base_spans(text), key=order)
        return base, sorted(base + self.random_spans(text), key=order)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join([f"{k}:{a}:{b}" for a, b, k in spans])


def find_secrets(df: DataFrame, ranks_path: str, policy: Policy = Policy(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every whole text; no shuffle.

    Null and empty texts have no spans. Positions are code points, the end exclusive. Repeated rows give repeated rows;
    other columns are not read. Time is linear in the text's length.
    """
    data = vocabulary(ranks_path)

    def make():
        scanner = Scanner(data, policy)

        def f(part):
            found = [scanner.scan(t) for t in part.column(1).to_pylist()]
            counts = [[sum(s[2] == k for s in every) for _, every in found] for k in KINDS]
            return [part.column(0), *counts, [sha256(joined(base).encode()).hexdigest() for base, _ in found], [joined(every) for _, every in found]]

        return f

    return map_text(df, [id_col, text_col], make, f"{id_col} bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string")


def redact(text: str | None, spans: str, mark: str = "[SECRET]") -> str | None:
    """The text with its spans, overlapping ones as one, replaced by a mark."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b in sorted((int(x), int(y)) for _, x, y in (s.split(":") for s in spans.split(","))):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])
