"""ZIP archives of stored members: written as a stream, read by ranges.

Only what range reads need: the end record, its ZIP64 form, the central directory, and where the bytes
of a stored member begin. All sizes and offsets are written in ZIP64 form.
"""

import struct
import zlib
from dataclasses import dataclass

# Signatures and layouts of the format's records.
LOCAL = struct.Struct("<4s5H3L2H")
CENTRAL = struct.Struct("<4s6H3L5H2L")
END = struct.Struct("<4s4H2LH")
END64 = struct.Struct("<4sQ2H2L4Q")
LOCATOR64 = struct.Struct("<4sLQL")
SIGN_LOCAL, SIGN_CENTRAL, SIGN_END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
SIGN_END64, SIGN_LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
STORED, UTF8, VERSION, ZIP64_FIELD = 0, 0x800, 45, 1
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
DAY = (1 << 5) | 1  # 1 January 1980, the first day the format knows


class ZipWriter:
    """Writes members one after the other to an open binary stream."""

    def __init__(self, stream):
        self.stream, self.offset, self.entries = stream, 0, []

    def add(self, name: str, data: bytes) -> None:
        raw, crc = name.encode(), zlib.crc32(data)
        sizes = struct.pack("<2H2Q", ZIP64_FIELD, 16, len(data), len(data))
        header = LOCAL.pack(
            SIGN_LOCAL, VERSION, UTF8, STORED, 0, DAY, crc, FULL32, FULL32, len(raw), len(sizes)
        )
        self.entries.append((raw, crc, len(data), self.offset))
        self._write(header + raw + sizes, data)

    def finish(self) -> None:
        start = self.offset
        for raw, crc, size, at in self.entries:
            extra = struct.pack("<2H3Q", ZIP64_FIELD, 24, size, size, at)
            fixed = CENTRAL.pack(
                SIGN_CENTRAL, VERSION, VERSION, UTF8, STORED, 0, DAY, crc, FULL32, FULL32,
                len(raw), len(extra), 0, 0, 0, 0, FULL32,
            )
            self._write(fixed + raw + extra)
        size, end, count = self.offset - start, self.offset, len(self.entries)
        self._write(
            END64.pack(SIGN_END64, END64.size - 12, VERSION, VERSION, 0, 0, count, count, size, start),
            LOCATOR64.pack(SIGN_LOCATOR64, 0, end, 1),
            END.pack(SIGN_END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0),
        )

    def _write(self, *parts: bytes) -> None:
        for part in parts:
            self.stream.write(part)
            self.offset += len(part)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int
    """Where its local header begins."""


class Ranges:
    """Ranges of a file that can seek; neighbouring ranges come from one read."""

    def __init__(self, file, size: int, ahead: int = 1 << 20):
        self.file, self.size, self.ahead = file, size, ahead
        self.start, self.held = 0, b""

    def __call__(self, start: int, length: int) -> bytes:
        if start < 0 or start + length > self.size:
            raise ValueError(f"range {start}+{length} outside of {self.size} bytes")
        at = start - self.start
        if at < 0 or at + length > len(self.held):
            self.file.seek(start)
            self.start, self.held = start, self.file.read(min(max(length, self.ahead), self.size - start))
            at = 0
        return self.held[at : at + length]


def members(ranges: Ranges) -> dict[str, Member]:
    """The members of an archive by name, from its central directory."""
    count, size, start = _directory(ranges)
    data, at, found = ranges(start, size), 0, {}
    for _ in range(count):
        fields = CENTRAL.unpack_from(data, at)
        if fields[0] != SIGN_CENTRAL:
            raise ValueError("no central directory entry where one should be")
        method, packed, plain = fields[4], fields[8], fields[9]
        names, extras, comments = fields[10:13]
        header = fields[16]
        at += CENTRAL.size
        name = data[at : at + names].decode()
        extra = _zip64(data[at + names : at + names + extras])
        wide = iter(struct.unpack(f"<{len(extra) // 8}Q", extra[: len(extra) // 8 * 8]))
        plain = next(wide) if plain == FULL32 else plain
        packed = next(wide) if packed == FULL32 else packed
        header = next(wide) if header == FULL32 else header
        at += names + extras + comments
        found[name] = Member(name, method, packed, header)
    return found


def data_start(ranges: Ranges, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is not stored: method {member.method}")
    fields = LOCAL.unpack(ranges(member.header, LOCAL.size))
    if fields[0] != SIGN_LOCAL:
        raise ValueError(f"no local header for {member.name}")
    return member.header + LOCAL.size + fields[9] + fields[10]


def _directory(ranges: Ranges) -> tuple[int, int, int]:
    """Number of entries, size and place of the central directory."""
    length = min(ranges.size, END.size + FULL16)
    tail = ranges(ranges.size - length, length)
    at = tail.rfind(SIGN_END)
    while at >= 0:  # a comment may hold the signature too
        if at + END.size <= length and at + END.size + END.unpack_from(tail, at)[7] == length:
            break
        at = tail.rfind(SIGN_END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive: no end record")
    _, _, _, _, count, size, start, _ = END.unpack_from(tail, at)
    end = ranges.size - length + at
    if end >= LOCATOR64.size:
        sign, _, place, _ = LOCATOR64.unpack(ranges(end - LOCATOR64.size, LOCATOR64.size))
        if sign == SIGN_LOCATOR64:
            fields = END64.unpack(ranges(place, END64.size))
            if fields[0] != SIGN_END64:
                raise ValueError("no ZIP64 end record where its locator points")
            count, size, start = fields[7:10]
    return count, size, start


def _zip64(extra: bytes) -> bytes:
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == ZIP64_FIELD:
            return extra[at + 4 : at + 4 + size]
        at += 4 + size
    return b""
