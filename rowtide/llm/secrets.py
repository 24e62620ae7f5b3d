"""Secrets: fixed patterns, and strings in a sensitive context that zstandard can't shorten."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the contract, in the order of their kinds; a match counts from this length on.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of [0-9a-f]+ is a match as a whole, so the shorter ones may be skipped
KINDS = ("assign", "access", "hex", "novel")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

#: Words that make what follows them sensitive.
SENSITIVE = re.compile(r"(?i:passw|pwd|secret|token|api.?key|credential|bearer|private.?key|access.?key|auth)")
#: A whole run of 16 or more, '.' inside included; a run's parts; the rest of a run.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-](?:[A-Za-z0-9+/_=-]|\.(?=[A-Za-z0-9+/_=-])){15,}")
_PART = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_REST = re.compile(r"(?:[A-Za-z0-9+/_=-]|\.(?=[A-Za-z0-9+/_=-]))*")
#: What lies between candidates of adjoining lines; the dashes that end a PEM block's first line; a PEM block's last body line.
_BREAK = re.compile(r"""["'`,;&|\\]*[ \t]*(?:\r?\n|\\(?=n))[ \t>#*|"'`]*""")
_DASHES = re.compile(r"[A-Z0-9 ]{0,40}-----")
_TAIL = re.compile(r"""["'`,;\\]*[ \t]*(?:\r?\n|\\(?=n))[ \t>#*|"'`]*([A-Za-z0-9+/=]{1,15})["'`,;\\]*[ \t]*(?:\r?\n|\\n)[ \t>#*|"'`]*-----END""")
_SENSITIVE_PARTS = ("passw", "pwd", "secret", "token", "api", "credential", "bearer", "private", "access", "auth")
#: Characters around a candidate, reach of a sensitive word, and length of the stretches of a run that are also measured.
_CONTEXT, _NEAR, _STRETCH = 400, 48, 200

#: Identifiers and literals of everyday code; they prime the compressor, so that strings made of them are no news.
IDENTIFIERS = """abstract access account action address allow application array assert async attribute auth authorization await
background backend base64 basic bearer before boolean bucket buffer build button bytes cache callback catch certificate change
character class client cluster column command comment commit component compress config configuration connect connection const
constructor container content context continue controller cookie count create credentials current database datetime debug
decode default define delete description destination dictionary directory disable document domain double download element
email enable encode encoding endpoint engine entity environment error event example exception execute expected export extends
factory false field filename filter finally float foreach format function generate getattr global group handler hash header
height hostname identifier image implements implementation import include index initialize input insert instance integer
interface internal invalid iterator javascript keyword language length library listener localhost location logger login
manager mapping markdown maximum message metadata method middleware minimum model module namespace network nullable number
object operator option output package parameter parent parse password path pattern payload permission placeholder platform
policy primary private process production profile project property protected protocol provider public python query queue
random reader record redirect reference region register release remote render replace repository request require resource
response result return schema search secret section select sender serialize server service session setting signature source
status storage string struct subscription success switch target template temporary terminal test thread timeout timestamp
title token transaction transform trigger tuple undefined unique update upload username utf-8 validate value variable vector
version view virtual void website while widget width window workspace wrapper writer your_api_key_here changeme xxxxxxxx
0123456789 abcdefghijklmnopqrstuvwxyz""".encode()
#: Code that stands before every context, so that a short one does not leave the compressor without statistics.
PREAMBLE = """const client = connect(host, port)
response = client.send(message, timeout=30) # return the status and then the value
if not response.ok: raise ValueError(f"request to {host} failed with {response.status}")
"""
_PRIMED = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def novelty(candidate: str, around: str) -> float:
    """Marginal compressed bytes per byte of ``candidate`` behind the text around it, identifiers being known.

    Random letters and digits cost 0.65 or more, strings made of known words 0.55 or less.
    """
    packer = zstandard.ZstdCompressor(level=12, dict_data=_PRIMED, write_content_size=False)
    known = (PREAMBLE + around).encode("utf-8", "replace")
    added = len(packer.compress(known + b" " + candidate.encode())) - len(packer.compress(known))
    return added / max(1, len(candidate))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns in one text."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def novel_spans(text: str, base: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
    """Incompressible strings right behind a sensitive word and outside the base spans."""
    low = text.lower() if not text.isascii() else text.casefold()
    if not any(p in low for p in _SENSITIVE_PARTS):
        return []
    found = _candidates(text, base)
    reached = _merged([(a, b) for a, b, _ in found] + [(a, b) for a, _, b in base])
    verdicts: dict[str, bool] = {}
    out: list[tuple[int, int, int]] = []
    places = []
    for start, end, inner in found:
        if inner and places and end <= places[-1][1] and verdicts[places[-1][2]]:
            continue  # lies in a run that is reported whole
        core = _core(text[start : min(end, start + _STRETCH) if inner else end])
        if not verdicts.get(core):
            verdicts[core] = _is_novel(text, start, end, reached, least, inner)
        places.append((start, end, core))
    for start, end, core in places:
        if verdicts[core] and not (out and start < out[-1][2]):
            out.append((start, 3, end))
            tail = _TAIL.match(text, end)
            if tail and not any(a < tail.end(1) and tail.start(1) < b for a, _, b in base):
                out.append((tail.start(1), 3, tail.end(1)))
    return out


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, lies in another) of the runs in reach of a sensitive word, outside the base spans; parts behind their run.

    In reach is what starts near the word, all of a PEM block whose first line ends with it, and what follows a run in reach on
    adjoining lines.
    """
    starts: dict[int, int] = {}
    inner: set[int] = set()
    run = (0, 0)
    for word in SENSITIVE.finditer(text):
        at = word.end()
        reach, last = at + _NEAR, -1
        dashes = _DASHES.match(text, at)
        if dashes:
            stop = text.find("-----", dashes.end())
            if text.startswith("-----END", stop):
                reach = max(reach, stop - 1)
        while True:
            lines = _BREAK.match(text, last) if last >= 0 else None
            # long enough for a run that starts within reach
            m = _CANDIDATE.search(text, at, min(len(text), max(reach, lines.end() if lines else 0) + 18))
            if m is None or m.start() > reach and not (lines and m.start() == lines.end()):
                break
            start = m.start()
            if start in starts:
                if start > reach:
                    break  # from there on the lines are known
                at = last = starts[start]
                continue
            if run[0] <= start < run[1]:
                inner.add(start)
            else:
                run = start, _REST.match(text, start).end()
            starts[start] = at = last = run[1]
    blocked = _merged([(a, b) for a, _, b in base])
    out: list[tuple[int, int, bool]] = []
    for start, end in sorted(starts.items()):
        i = bisect_right(blocked, (start, len(text) + 1)) - 1
        free, at, i = [], start, max(0, i)
        while i < len(blocked) and blocked[i][0] < end:
            if blocked[i][1] > start:
                free.append((at, blocked[i][0]))
                at = blocked[i][1]
            i += 1
        free.append((at, end))
        for a, b in free:
            a += text[a : a + 1] == "."
            b -= text[b - 1] == "."
            if b - a >= 16:
                out.append((a, b, start in inner))
                if start not in inner and "." in text[a:b]:
                    out += [(*p.span(), True) for p in _PART.finditer(text, a, b)]
    return sorted(set(out), key=lambda x: (x[0], -x[1], x[2]))


def _is_novel(text: str, start: int, end: int, reached: list[tuple[int, int]], least: float, inner: bool) -> bool:
    """Whether a run is as a whole, or one of its stretches; of a run inside another one the first stretch is new."""

    def measured(a: int, b: int) -> bool:
        return novelty(text[a:b], _around(text, a, b, reached)) >= least

    if end - start <= _STRETCH:
        return measured(start, end)
    if inner:
        return measured(start, start + _STRETCH)
    return measured(start, end) or any(measured(a, min(end, a + _STRETCH)) for a in range(start, end - 15, _STRETCH))


def _core(candidate: str) -> str:
    """What two candidates are compared by: signs at either end may belong to the syntax around."""
    return candidate.strip("+/_=.-") or candidate


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _around(text: str, start: int, end: int, reached: list[tuple[int, int]]) -> str:
    """The text around a candidate without its other occurrences, of which an earlier one outside ``reached`` stays: that one is public."""
    core = _core(text[start:end])
    low, high = max(0, start - _CONTEXT), min(len(text), end + _CONTEXT)
    parts, at = [], low
    place = text.find(core, max(0, low - len(core) + 1), high + len(core) - 1)
    while place >= 0:
        behind = place + len(core)
        i = bisect_right(reached, (place, len(text) + 1)) - 1
        if place >= start or (i >= 0 and behind <= reached[i][1]):
            parts.append(text[at : max(at, min(place, start))] + text[max(at, end) : max(place, end, at)])
            at = max(at, behind)
        place = text.find(core, place + 1, high + len(core) - 1)
    parts.append(text[at : max(at, start)] + text[max(at, end) : max(at, end, high)])
    return "".join(parts)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_text(text: str | None, least: float = 0.62) -> tuple[int, int, int, str, str]:
    """Counts per fixed kind, digest of their spans, and all spans."""
    text = text or ""
    base = base_spans(text)
    spans = sorted(base + novel_spans(text, base, least))
    counts = [sum(k == i for _, k, _ in base) for i in range(3)]
    return *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)


def _scan(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(),) * 3 + (pa.string(),) * 2
        for batch in batches:
            found = [scan_text(t.as_py(), least) for t in batch.column(1)]
            if found:
                columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def find_secrets(docs: DataFrame, least_novelty: float = 0.62) -> DataFrame:
    """doc_id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` per row of ``docs`` (doc_id, text).

    ``spans`` lists kind:start:end (code points, end exclusive) of the fixed kinds and of ``novel`` strings: whole
    runs of 16 or more of ``A-Za-z0-9+/_=-``, with single dots inside, in reach of a sensitive word, whose marginal compressed
    size (or that of one of their dotted parts or 200-character stretches) is ``least_novelty`` or more of their length; there is no
    upper length. In reach is a run that starts within 48 characters behind the word, every line of a PEM private key up to
    its END line, and a run that begins the line behind one in reach. If only a dotted part is novel, that part is reported. The size is that behind the 400 characters before and behind, without other occurrences of the string; only an
    earlier one that no sensitive word precedes makes it known. All occurrences within reach of a sensitive word share
    one verdict: novel where any of them is. Spans are ordered by start, then kind. Whole texts are read, a null text counts as empty, rows repeating
    an id are scanned each for itself. Other columns are ignored; an empty table gives no rows. No shuffle.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_scan(least_novelty), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
