"""ZIP containers of WARC members: a writer for stored members and a reader that
finds them through the central directory (ZIP64 included) and reads byte ranges.

The reader works on any seekable file object with ``size()`` and
``read_at(length, offset)`` (such as the files of ``pyarrow.fs``), and never
reads or unpacks a whole member.
"""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_TOP16, _TOP32 = 0xFFFF, 0xFFFFFFFF


class Member(NamedTuple):
    name: str
    method: int       # 0: stored
    size: int         # bytes in the container
    header: int       # offset of the local header


def write_stored(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A container of stored members; ``zip64`` writes the 64-bit records even
    where they are not needed."""
    out, central = [], []
    at = 0
    for name, data in members:
        raw, crc, wide = name.encode(), zlib.crc32(data), zip64 or len(data) >= _TOP32
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if wide else b""
        size = _TOP32 if wide else len(data)
        head = struct.pack("<4sHHHHHIIIHH", _LOCAL, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, size, size,
                           len(raw), len(extra)) + raw + extra
        far = zip64 or at >= _TOP32
        more = (struct.pack("<QQ", len(data), len(data)) if wide else b"") + (struct.pack("<Q", at) if far else b"")
        extra = struct.pack("<HH", 1, len(more)) + more if more else b""
        central.append(struct.pack("<4sHHHHHHIIIHHHHHII", _CENTRAL, 45, 45 if more else 20, 0x800, 0, 0, 0x21, crc,
                                   size, size, len(raw), len(extra), 0, 0, 0, 0, _TOP32 if far else at) + raw + extra)
        out += [head, data]
        at += len(head) + len(data)
    directory = b"".join(central)
    n, end = len(members), b""
    if zip64 or n >= _TOP16 or at >= _TOP32 or len(directory) >= _TOP32:
        end = (struct.pack("<4sQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, n, n, len(directory), at)
               + struct.pack("<4sIQI", _LOCATOR64, 0, at + len(directory), 1))
        n, size, start = _TOP16, _TOP32, _TOP32
    else:
        size, start = len(directory), at
    return b"".join([*out, directory, end, struct.pack("<4sHHHHIIH", _END, 0, 0, n, n, size, start, 0)])


def read_directory(file) -> list[Member]:
    """Members by the central directory. Raises ValueError on a file that is no ZIP container."""
    size = file.size()
    tail_at = max(0, size - 22 - _TOP16)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(_END)
    while end >= 0:  # the comment after the record must reach the end of the file
        if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
        end = tail.rfind(_END, 0, end)
    if end < 0:
        raise ValueError("no end of central directory record")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = tail_at + end - 20
    if _TOP16 == count or _TOP32 in (length, start):
        mark = file.read_at(20, locator) if locator >= 0 else b""
        if mark[:4] != _LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = file.read_at(56, struct.unpack_from("<Q", mark, 8)[0])
        if record[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory record")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    data, at, out = file.read_at(length, start), 0, []
    for _ in range(count):
        if data[at:at + 4] != _CENTRAL:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, plain = struct.unpack_from("<II", data, at + 20)
        names, extras, comments = struct.unpack_from("<HHH", data, at + 28)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + names]
        extra = data[at + 46 + names:at + 46 + names + extras]
        for field in _fields(extra):
            if field[0] == 1:
                wide = list(struct.unpack(f"<{len(field[1]) // 8}Q", field[1][:len(field[1]) // 8 * 8]))
                if plain == _TOP32:
                    plain = wide.pop(0)
                if packed == _TOP32:
                    packed = wide.pop(0)
                if header == _TOP32:
                    header = wide.pop(0)
        out.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, packed, header))
        at += 46 + names + extras + comments
    return out


def _fields(extra: bytes):
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        yield kind, extra[at + 4:at + 4 + n]
        at += 4 + n


def data_start(file, member: Member) -> int:
    """Offset of a stored member's first byte."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    head = file.read_at(30, member.header)
    if head[:4] != _LOCAL:
        raise ValueError(f"{member.name}: no local header")
    names, extras = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + names + extras
