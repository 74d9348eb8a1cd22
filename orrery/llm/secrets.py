"""Secrets in text: known forms, and strings that a tokenizer can hardly shorten.

Natural words and identifiers are made of frequent byte sequences, so a vocabulary of
merges covers them with few tokens. A random string needs a token for every two
characters or so. What the known forms leave of a run of key characters, less the known
kinds of digests and identifiers, is reported where it has few characters a token:

* a part between separators, by the mean of the whole part;
* a stretch of tokens, by every window of `WINDOW` tokens in it. So a random string is
  found behind a natural name that would lift the mean of the run, and a key that holds
  separators is found over them.

The vocabulary alone decides, whatever kinds of characters there are: it packs three or
two digits to a token, so a number is rarely random by this test.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from orrery.llm.rows import named, with_results
from orrery.llm.words import text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How text is split before merging (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Kinds of spans, in the order that breaks ties.
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_RANDOM = 8, 16, 32, 16
#: Fewer characters a token than this is a random string.
CHARACTERS_A_TOKEN = 2.0
#: Tokens looked at together.
WINDOW = 7
#: Fewer different characters are a repetition.
LEAST_DIFFERENT = 6
#: A longer run is split into tokens in blocks of this many characters.
BLOCK = 4096

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_STEMS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")
_RANDOM = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_RANDOM},}}")
_PART = re.compile(rf"[A-Za-z0-9]{{{LEAST_RANDOM},}}")
#: Digests by their usual lengths, UUIDs and the digests of package locks are not secret.
_KNOWN = re.compile(
    r"(?<![A-Za-z0-9])(?:"
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})"
    r"|sha(?:1|256|384|512)-[A-Za-z0-9+/]+=*"
    r")(?![A-Za-z0-9])"
)
_KEY_BYTES = np.zeros(256, bool)
_KEY_BYTES[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
RESULTS = {"spans": "array<struct<kind:string,start:int,end:int>>"}


@lru_cache(maxsize=2)
def _encoding(ranks: bytes) -> tiktoken.Encoding:
    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("shared", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


@lru_cache(maxsize=2)
def _token_table(ranks: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of every token its number of bytes, and whether it begins with a letter or digit."""
    encoding = _encoding(ranks)
    size = np.zeros(encoding.n_vocab, np.int64)
    letters = np.zeros(encoding.n_vocab, bool)
    for line in ranks.splitlines():
        token, number = line.split()
        name = base64.b64decode(token)
        size[int(number)], letters[int(number)] = len(name), name[:1].isalnum()
    return size, letters


def random_stretches(
    piece: str, ranks: bytes, characters_a_token: float = CHARACTERS_A_TOKEN
) -> list[tuple[int, int]]:
    """(start, end) of the disjoint random strings in a piece of key characters, ascending.

    Separators (`+/_=-`) are no tokens here, and a window more than a quarter of which is
    separators is left out: dates and lists of short words have no long names in them. Tokens
    under four characters beside a random string may be in its span.
    """
    sizes, letters = _token_table(ranks)
    encoding = _encoding(ranks)
    tokens = np.array(
        [t for i in range(0, len(piece), BLOCK) for t in encoding.encode_ordinary(piece[i : i + BLOCK])], np.int64
    )
    size = sizes[tokens]
    end = np.cumsum(size)
    own = letters[tokens]
    size, end = size[own], end[own]
    begin = end - size
    spans = []
    if len(size) >= WINDOW:
        held = np.convolve(size, np.ones(WINDOW, np.int64), "valid")
        reach = end[WINDOW - 1 :] - begin[: len(held)]
        low = (held < characters_a_token * WINDOW) & (4 * (reach - held) <= reach)
        inside = np.convolve(low, np.ones(WINDOW, np.int64)) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0]))))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            # natural tokens at its ends came in with the windows over them
            small = a + np.flatnonzero(size[a:b] < 2 * characters_a_token)
            if len(small):
                spans.append((int(begin[small[0]]), int(end[small[-1]])))
    for m in _PART.finditer(piece):
        n = np.searchsorted(begin, m.end()) - np.searchsorted(begin, m.start())
        if m.end() - m.start() < characters_a_token * n:
            spans.append(m.span())
    joined: list[list[int]] = []
    for a, b in sorted(spans):
        if joined and a < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    return [
        (a, b) for a, b in joined if b - a >= LEAST_RANDOM and len(set(piece[a:b])) >= LEAST_DIFFERENT
    ]


def random_spans(
    text: str, base: list[tuple[int, int]], ranks: bytes, characters_a_token: float = CHARACTERS_A_TOKEN
) -> list[tuple[int, int]]:
    """(start, end) of the random strings of a text that lie beside the sorted spans `base`."""
    found = []
    first = 0
    for m in _RANDOM.finditer(text):
        run, at = m.group(), m.start()
        while first < len(base) and base[first][1] <= at:
            first += 1
        taken = [(s - at, e - at) for s, e in _until(base, first, m.end())]
        taken += [k.span() for k in _KNOWN.finditer(run)]
        done = 0
        for s, e in [*sorted(taken), (len(run), len(run))]:
            if s - done >= LEAST_RANDOM:
                stretches = random_stretches(run[done:s], ranks, characters_a_token)
                found += [(at + done + a, at + done + b) for a, b in stretches]
            done = max(done, e)
    return found


def _until(base: list[tuple[int, int]], first: int, end: int):
    while first < len(base) and base[first][0] < end:
        yield base[first]
        first += 1


def base_spans(text: str, lowered: bytes) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the known forms; `lowered` are the text's bytes."""
    found = []
    if any(stem in lowered for stem in _STEMS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_VALUE:
                found.append((m.start(), 0, m.end()))
    if b"akia" in lowered:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append((m.start(), 1, m.end()))
    return found


def _long_runs(raw: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> np.ndarray:
    """Which texts have `least` of these bytes in a row."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = member[raw]
    change = np.flatnonzero(inside[1:] != inside[:-1])
    begins, stops = change[::2], change[1::2]
    long = stops - begins >= least
    out = np.zeros(len(offsets) - 1, bool)
    # a run may reach over texts; then all of them are looked at
    first = np.searchsorted(offsets, begins[long], side="right") - 1
    last = np.searchsorted(offsets, stops[long], side="left") - 1
    for a, b in zip(first.tolist(), last.tolist()):
        out[a : b + 1] = True
    return out


def find_secrets(
    docs: DataFrame,
    keep: list[str],
    *,
    text: str = "text",
    vocabulary: str = VOCABULARY,
    characters_a_token: float = CHARACTERS_A_TOKEN,
) -> DataFrame:
    """The columns `keep`, and the spans of every text as (kind, start, end).

    Positions are code points, the end exclusive; spans are ordered by start, then
    kind as in `KINDS`. `assign`, `access` and `hex` are the known forms, leftmost and
    without overlap inside a kind; `random` spans are the strings of at least
    `LEAST_RANDOM` characters that the vocabulary can hardly shorten, and overlap none of
    those. A null or empty text has no spans; repeated rows have each their own.
    The vocabulary file is read on the driver and broadcast (below a megabyte).
    """
    with open(vocabulary, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    hex_bytes = np.zeros(256, bool)
    hex_bytes[[ord(c) for c in "0123456789abcdef"]] = True

    def prepare():
        ranks = sent.value

        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            raw, offsets = text_bytes(columns[0])
            has_hex = _long_runs(raw, offsets, hex_bytes, LEAST_HEX)
            has_run = _long_runs(raw, offsets, _KEY_BYTES, LEAST_RANDOM)
            lowered = raw.tobytes().translate(_LOWER)
            out = []
            for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                low = lowered[a:b]
                spans: list[tuple[int, int, int]] = []
                if has_hex[i] or has_run[i] or b"akia" in low or any(s in low for s in _STEMS):
                    body = columns[0][i].as_py() or ""
                    spans = base_spans(body, low)
                    if has_hex[i]:
                        spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(body)]
                    if has_run[i]:
                        base = sorted((s, e) for s, _, e in spans)
                        found = random_spans(body, base, ranks, characters_a_token)
                        spans += [(s, 3, e) for s, e in found]
                out.append(
                    [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)]
                )
            span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
            return [pa.array(out, pa.list_(span))]

        return compute

    return with_results(docs, keep, [named(docs, text)], RESULTS, prepare)
