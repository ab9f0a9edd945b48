"""Secrets in whole texts: three kinds of patterns, and runs of characters with high entropy.

Patterns (``assign``, ``access``, ``hex``) are the leftmost matches of their kind that do not overlap.
Candidates for entropy are the longest runs of letters, digits and ``+/_=-`` of ``LEAST`` characters or
more, found for a whole batch of texts at once from its bytes. Each candidate belongs to the narrowest
character class that holds all of it (digits, hexadecimal, letters of one case, base 64); a window of the
class's width slides along it, and its Shannon entropy follows from incremental counts: one character
enters, one leaves, and the sum of n log2 n changes by two entries of a table of integers, so that equal
windows have equal entropies wherever they stand. Windows at or above the class's threshold, merged
where they overlap, are spans of kind ``entropy-<class>``.

An allow-list suppresses entropy spans (never pattern matches): identifiers that are public by their form,
digests that are announced as such, paths and links, alphabets in order, and example keys.

Nulls and empty texts have no spans; a text of one long run costs one step a character. Other columns
are kept as they are; rows are never joined or shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.llm.common import portions, utf8_buffer

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
#: One of these, whatever its letters' case, stands in every ``assign`` match.
CLUES = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

#: Candidates of fewer characters are not looked at.
LEAST = 20


class CharacterClass(NamedTuple):
    name: str
    characters: str
    width: int
    bits: float


#: Narrowest first; the thresholds lie between words of the class and random strings of it.
CLASSES = (
    CharacterClass("digit", "0123456789", 20, 3.0),
    CharacterClass("hex", "0123456789abcdefABCDEF", 20, 3.2),
    CharacterClass("lower", "abcdefghijklmnopqrstuvwxyz", 24, 4.1),
    CharacterClass("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 24, 4.1),
    CharacterClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.9),
)
#: Entropy spans inside a match of one of these are not secrets.
ALLOWED = (
    ("uuid", re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")),
    ("digest", re.compile(r"(?i:md5|sha-?1|sha-?256|sha-?512|checksum|digest|commit|etag|integrity)"
                          r"[\"']?[ ]?[:= -][ ]?[\"']?[0-9A-Za-z+/=_-]+")),
    ("path", re.compile(r"[0-9A-Za-z_-]*(?:/[a-z][a-z_-]*){2,}/?[0-9A-Za-z_-]*")),
    ("link", re.compile(r"[a-z]{2,8}://[^\x00-\x20\"<>]+")),
    ("example", re.compile(r"[0-9A-Za-z+/_=-]*(?:EXAMPLE|example|placeholder|changeme|xxxx)[0-9A-Za-z+/_=-]*")),
    ("words", re.compile(r"(?:[A-Za-z]?[a-z]+[_-]){2,}[A-Za-z]?[a-z]+")),
)
#: Runs in this order are alphabets, not secrets.
ORDERED = "0123456789abcdefghijklmnopqrstuvwxyz", "qwertyuiopasdfghjklzxcvbnm", "zyxwvutsrqponmlkjihgfedcba9876543210"
ORDERED_SHARE = 0.7

_MEMBER = np.zeros(256, bool)
_MEMBER[[ord(c) for c in CLASSES[-1].characters]] = True
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_SETS = [(c, frozenset(c.characters)) for c in CLASSES]
_SCALE = 1 << 40
#: n log2 n as integers, for every count in a window.
_LOGS = [0] + [round(n * math.log2(n) * _SCALE) for n in range(1, max(c.width for c in CLASSES) + 1)]


def class_of(text: str) -> CharacterClass | None:
    """The narrowest class that holds every character."""
    present = set(text)
    return next((c for c, members in _SETS if present <= members), None)


def entropies(text: str, width: int) -> list[float]:
    """Shannon entropy in bits of each window of ``width`` characters, by incremental counts."""
    counts: dict[str, int] = {}
    total, out, bits = 0, [], math.log2(width)
    for i, entering in enumerate(text):
        n = counts.get(entering, 0)
        if i >= width:
            leaving = text[i - width]
            m = counts[leaving]
            total += _LOGS[m - 1] - _LOGS[m]
            counts[leaving] = m - 1
            n = counts.get(entering, 0)
        total += _LOGS[n + 1] - _LOGS[n]
        counts[entering] = n + 1
        if i >= width - 1:
            out.append(bits - total / (_SCALE * width))
    return out


def _in_order(text: str) -> bool:
    """Most neighbours follow each other in an alphabet or on a keyboard."""
    low = text.lower()
    follow = sum(any(low[i:i + 2] in run for run in ORDERED) for i in range(len(low) - 1))
    return follow >= ORDERED_SHARE * (len(low) - 1)


def high_entropy(candidate: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the candidate's stretches of windows at or above its class's threshold."""
    found: list[list[int]] = []
    kind = class_of(candidate)
    if kind is None or len(candidate) < kind.width:
        return []
    for i, bits in enumerate(entropies(candidate, kind.width)):
        if bits >= kind.bits:
            if found and i <= found[-1][1]:
                found[-1][1] = i + kind.width
            else:
                found.append([i, i + kind.width])
    return [(f"entropy-{kind.name}", a, b) for a, b in found if not _in_order(candidate[a:b])]


def _runs(member: np.ndarray, raw: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end byte in it of each longest run of member bytes with ``least`` bytes or more."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = member[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # a run ends where its row does
    bounds = offsets[1:-1]
    bounds = np.unique(bounds[(bounds > 0) & (bounds < len(raw))])
    if len(bounds):
        cut = bounds[(inside[bounds] == 1) & (inside[bounds + 1] == 1)]
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return rows, starts - offsets[rows], ends - offsets[rows]


def _code_points(raw: np.ndarray, begin: int, places: np.ndarray) -> np.ndarray:
    """Code points before each byte place of a row that begins at byte ``begin``."""
    if not len(places):
        return places
    lead = (raw[begin:begin + int(places.max())] & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(lead)])
    return before[places]


def spans_of(text: str, hexes: list[tuple[int, int]], candidates: list[tuple[int, int]],
             low: bytes | None = None) -> list[tuple[str, int, int]]:
    """All spans of one text, by start and then kind, given its hexadecimal and candidate runs."""
    low = text.encode().lower() if low is None else low
    found = []
    if any(clue in low for clue in CLUES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", a, b) for a, b in hexes]
    extra = [(kind, a + i, a + j) for a, b in candidates for kind, i, j in high_entropy(text[a:b])]
    found += [s for s in extra if not _allowed(text, s[1], s[2])] if extra else []
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (s[1], rank.get(s[0], len(KINDS)), s[0], s[2]))


#: Characters beside a span in which an allowed form that covers it is looked for.
BESIDE = 200


def _allowed(text: str, start: int, end: int) -> bool:
    a = max(0, start - BESIDE)
    near = text[a:end + BESIDE]
    return any(m.start() + a <= start and end <= m.end() + a for _, form in ALLOWED for m in form.finditer(near))


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in portions(batches, 1):
        raw, offsets = utf8_buffer(part.column(1))
        n = part.num_rows
        where: list[dict[str, list]] = [{"hex": [], "run": []} for _ in range(n)]
        for name, member, least in (("hex", _HEX, LEAST_HEX), ("run", _MEMBER, LEAST)):
            rows, starts, ends = _runs(member, raw, offsets, least)
            for r in np.unique(rows):
                mine = rows == r if len(rows) < 64 else slice(*np.searchsorted(rows, [r, r + 1]))
                points = _code_points(raw, int(offsets[r]), np.concatenate([starts[mine], ends[mine]]))
                half = len(points) // 2
                where[r][name] = list(zip(points[:half].tolist(), points[half:].tolist()))
        spans = []
        for i, text in enumerate(part.column(1).to_pylist()):
            if text is None:
                spans.append([])
                continue
            low = raw[offsets[i]:offsets[i + 1]].tobytes().lower()
            spans.append([{"kind": k, "start": a, "end": b}
                          for k, a, b in spans_of(text, where[i]["hex"], where[i]["run"], low)])
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _SPAN)], names=["row", "spans"])


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``spans``, an array of (kind, start, end) in code points.

    A column of ``docs`` named ``spans`` is replaced.
    """
    names = [c for c in docs.columns if c != "spans"]
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in names]
    row = F.struct(*[q.alias(f"c{i}") for i, q in enumerate(quoted)]).alias("row")
    given = docs.select(row, F.col("`" + text.replace("`", "``") + "`").cast("string").alias("text"))
    span = T.StructType.fromDDL("kind string, start long, `end` long")
    schema = T.StructType([given.schema["row"], T.StructField("spans", T.ArrayType(span))])
    found = given.mapInArrow(_scan, schema)
    return found.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(names)], "spans")


def listed(spans: str = "spans", kinds: tuple[str, ...] | None = None):
    """Spans as one string ``kind:start:end,...``; all of them, or those of ``kinds``."""
    chosen = F.col(spans) if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(kind: str, spans: str = "spans"):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
