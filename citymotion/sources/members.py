"""Byte ranges of files and of archive members, for sources that split.

``locate`` reads an archive's central directory (a range read at its end) and says where a
member's bytes lie.  A stored member, like a plain file, can be read from any offset, so
its records can be dealt to many tasks; a deflated one can only be inflated from its start
and is one task, read as a stream.
"""

from __future__ import annotations

import struct
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from citymotion.sources.common import open_input


def is_data_member(name: str, suffixes: Sequence[str] = (".csv",)) -> bool:
    """Tabular member, not resource-fork junk (``__MACOSX/``, ``._name``)."""
    low = name.lower()
    base = name.rsplit("/", 1)[-1]
    return low.endswith(tuple(suffixes)) and "__macosx" not in low and not base.startswith("._")


@dataclass(frozen=True)
class Member:
    """Bytes of a file (``name`` empty) or of an archive member; ``offset`` is set if they lie
    there as they are."""

    path: str
    name: str
    size: int
    offset: int | None


def locate(path: str, suffixes: Sequence[str]) -> list[Member]:
    """The members of the archive (or the plain file) at ``path`` with one of ``suffixes``."""
    with open_input(path) as fh:
        if not path.lower().endswith(".zip"):
            return [Member(path, "", fh.size(), 0)] if is_data_member(path, suffixes) else []
        out = []
        with zipfile.ZipFile(fh) as zf:
            for info in zf.infolist():
                if not is_data_member(info.filename, suffixes):
                    continue
                at = None
                if info.compress_type == zipfile.ZIP_STORED:
                    fh.seek(info.header_offset + 26)  # fixed value: place of the two lengths in a local header
                    names, extra = struct.unpack("<HH", fh.read(4))
                    at = info.header_offset + 30 + names + extra
                out.append(Member(path, info.filename, info.file_size, at))
        return out


class Bytes:
    """Reads ranges of a member: anywhere if it is stored, forwards only if it is deflated."""

    def __init__(self, member: Member):
        self.member, self._raw, self._zip = member, open_input(member.path), None
        if member.offset is None:
            self._zip = zipfile.ZipFile(self._raw)
            self._stream, self._at = self._zip.open(member.name), 0

    def read(self, start: int, length: int) -> bytes:
        if self._zip is None:
            self._raw.seek(self.member.offset + start)
            return self._raw.read(min(length, max(0, self.member.size - start)))
        if start < self._at:
            raise ValueError("a deflated member is read forwards only")
        while self._at < start:
            self._at += len(self._stream.read(min(1 << 20, start - self._at))) or (start - self._at)
        data = self._stream.read(length)
        self._at += len(data)
        return data

    def __enter__(self) -> Bytes:
        return self

    def __exit__(self, *_: object) -> None:
        if self._zip is not None:
            self._stream.close()
            self._zip.close()
        self._raw.close()


def spans(n: int, per: int) -> Iterator[tuple[int, int]]:
    """(first, count) of ranges of ``per`` records."""
    for first in range(0, n, max(1, per)):
        yield first, min(per, n - first)
