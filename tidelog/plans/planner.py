"""Planning of scans: the chain of files, positions in it, and ranges to read.

A folder's ``.next`` names its first file and ``<file>.next`` that file's successor.
A range may start at a file's beginning or where a transaction does, because rows
need the table maps before them.  The planner cuts files by size alone, reading no more of each
than its first events; the task of a range looks for the transactions that start at or after
its nominal ends (``settled``), which neighbours do alike.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, replace

import numpy as np

from ..functions.names import EVENT
from ..sources.events import FORMAT, GTIDS, HEADER, MAGIC, XID, Format, decode_format, detect_version, read_header
from ..sources.files import Folder

RANGE_BYTES = 16 << 20
FIRST = 4
_CHUNK = 8 << 20
_LOOK = 128 << 10


@dataclass(frozen=True)
class Range:
    """Bytes of a file.  Ends that are ``loose`` are nominal."""

    file: str
    seq: int
    start: int
    end: int
    loose_start: bool = False
    loose_end: bool = False


def next_of(folder: Folder, name: str = "") -> str | None:
    link = f"{name}.next"
    if not folder.has(link):
        return None
    return folder.read(link).decode("utf-8").strip() or None


def list_files(folder: Folder) -> list[str]:
    """Files in order of creation, up to the first missing link."""
    if not folder.exists():
        raise NotADirectoryError(folder.path)
    out, seen, name = [], set(), next_of(folder)
    while name is not None and folder.has(name):
        if name in seen:
            raise ValueError(f"the chain of {folder.path} comes back to {name}")
        out.append(name)
        seen.add(name)
        name = next_of(folder, name)
    return out


def check_magic(folder: Folder, name: str) -> bool:
    """False for a file too short to tell; a wrong one is an error."""
    head = folder.read(name, 0, 4)
    if len(head) < 4:
        return False
    if head != MAGIC:
        raise ValueError(f"{name} is no log file")
    return True


def file_format(folder: Folder, name: str) -> Format:
    head = folder.read(name, FIRST, 19)
    if len(head) < 19:
        return Format()
    h = read_header(head, 0)
    if h.type != FORMAT:
        return Format(version=detect_version(h.type, h.size))
    body = folder.read(name, FIRST + 19, h.size - 19)
    return decode_format(body)


def hop(folder: Folder, name: str, start: int = FIRST, chunk: int = _CHUNK):
    """(position, type, size) of the complete events of a file, from headers alone."""
    size, pos, base, data = folder.size(name), start, start, b""
    while pos + 19 <= size:
        if pos + 19 > base + len(data):
            base, data = pos, folder.read(name, pos, chunk)
        _, kind, _, n, _, _ = struct.unpack_from(HEADER, data, pos - base)
        if n < 19:
            raise ValueError(f"{name}: an event of {n} bytes at {pos}")
        if pos + n > size:
            return
        yield pos, kind, n
        pos += n


def end_position(folder: Folder) -> tuple[str, int]:
    """The last file and the end of its last complete event; ("", 0) of an empty folder."""
    files = list_files(folder)
    if not files:
        return "", 0
    end = FIRST
    if check_magic(folder, files[-1]):
        for pos, _, n in hop(folder, files[-1]):
            end = pos + n
    return files[-1], end


def safe_end(folder: Folder, name: str, start: int = FIRST) -> int:
    """The last place, of those after complete transactions, where reading may go on."""
    safe, inside = start, False
    for pos, kind, n in hop(folder, name, start):
        if kind in GTIDS:
            safe, inside = pos, True
        if kind in (EVENT["tableMap"], EVENT["query"]):
            inside = True
        if kind == XID or kind in (EVENT["rotate"], EVENT["stop"]) or not inside:
            safe, inside = pos + n, False
    return safe


def resolve(folder: Folder, text: str | None) -> tuple[str, int]:
    """``earliest``, ``latest``, ``FILE`` or ``FILE:POS`` (decimal, 0x, 0o or 0b)."""
    if not text or text == "earliest":
        files = list_files(folder)
        return (files[0], FIRST) if files else ("", 0)
    if text == "latest":
        return end_position(folder)
    name, _, pos = text.partition(":")
    return name, int(pos, 0) if pos else FIRST


def may_cut(folder: Folder, name: str) -> bool:
    """Whether headers tell their own place in this file, as those of a copy from elsewhere may not."""
    head = folder.read(name, FIRST, 19)
    if len(head) < 19:
        return False
    _, kind, _, size, ahead, _ = struct.unpack_from(HEADER, head, 0)
    return kind == FORMAT and ahead == FIRST + size


def boundary(folder: Folder, name: str, at: int, size: int) -> int:
    """Where the first event at or after a place begins; the file's end without one.  A header tells its
    event's size and the place after it: where these agree, here and in the event that follows, an event begins."""

    def agree(pos: int) -> bool:
        head = folder.read(name, pos, 19)
        if len(head) < 19:
            return True  # a torn tail
        _, _, _, n, ahead, _ = struct.unpack_from(HEADER, head, 0)
        return n >= 19 and ahead == (pos + n) & 0xFFFFFFFF

    look = _LOOK
    while at + 19 <= size:
        data = np.frombuffer(folder.read(name, at, look + 18), np.uint8)
        m = len(data) - 18
        if m <= 0:
            break

        def number(skip: int) -> np.ndarray:
            return sum(data[skip + i : skip + i + m].astype(np.uint32) << np.uint32(8 * i) for i in range(4))

        length, ahead = number(9), number(13)
        place = (np.arange(m, dtype=np.uint64) + np.uint64(at)).astype(np.uint32)
        for i in np.flatnonzero((length >= 19) & (ahead == place + length)).tolist():
            if at + i + int(length[i]) <= size and agree(at + i + int(length[i])):
                return at + i
        at, look = at + m, min(look * 4, _CHUNK)
    return size


def settled(folder: Folder, r: Range) -> Range:
    """A range with its loose ends moved to where the next transaction starts."""
    size = folder.size(r.file)

    def ahead(at: int) -> int:
        for pos, kind, n in hop(folder, r.file, boundary(folder, r.file, at, size), _LOOK):
            if kind in GTIDS:
                return pos
            if kind == XID or kind in (EVENT["rotate"], EVENT["stop"]):
                return pos + n
        return size

    start = ahead(r.start) if r.loose_start else r.start
    if r.loose_end:
        return replace(r, start=start, end=max(start, ahead(r.end)), loose_start=False, loose_end=False)
    return replace(r, start=min(start, r.end), loose_start=False)


def plan(folder: Folder, start: str | None = None, until: tuple[str, int] | None = None, range_bytes: int = RANGE_BYTES) -> list[Range]:
    """Ranges from a position on, of about equal sizes."""
    files = list_files(folder)
    name, pos = resolve(folder, start)
    if not files or not name:
        return []
    if name not in files:
        raise FileNotFoundError(f"{name} is not in {folder.path}")
    out = []
    first = files.index(name)
    last = files.index(until[0]) if until else len(files) - 1
    for seq in range(first, last + 1):
        f = files[seq]
        if not check_magic(folder, f):
            continue
        begin = pos if seq == first else FIRST
        end = until[1] if until and seq == last else folder.size(f)
        if begin >= end:
            continue
        cuts = [begin, end]
        if end - begin > range_bytes and may_cut(folder, f):
            cuts = [*range(begin, end, range_bytes), end]
        out += [Range(f, seq, a, b, a != begin, b != end) for a, b in zip(cuts, cuts[1:])]
    return out
