"""Reads native files back, for tests only."""

import struct

SIGNATURE = bytes([0x4E, 0x41, 0x54, 0x49, 0x56, 0x45, 0x0A, 0xFF, 0x0D, 0x0A, 0x00])


def read_rows(data, kinds):
    """Rows of one file; kinds are 'int', 'float', 'bool', 'text' or 'bytes' per column."""
    assert data[:11] == SIGNATURE
    length, version, filler, n = struct.unpack_from("<ihbh", data, 11)
    assert (length, version, filler, n) == (5 + 4 * len(kinds), 1, 0, len(kinds))
    widths = struct.unpack_from(f"<{n}i", data, 20)
    at, rows = 20 + 4 * n, []
    while at < len(data):
        (size,) = struct.unpack_from("<i", data, at)
        at += 4
        bits = data[at:at + (n + 7) // 8]
        at += len(bits)
        start, row = at, []
        for i, (width, kind) in enumerate(zip(widths, kinds)):
            if bits[i // 8] >> (7 - i % 8) & 1:
                row.append(None)
                continue
            if width < 0:
                (width,) = struct.unpack_from("<i", data, at)
                at += 4
            raw = data[at:at + width]
            at += width
            row.append({
                "int": lambda: int.from_bytes(raw, "little", signed=True), "float": lambda: struct.unpack("<d", raw)[0],
                "bool": lambda: raw == b"\x01", "text": lambda: raw.decode(), "bytes": lambda: raw,
            }[kind]())
        assert at - start == size
        rows.append(tuple(row))
    return rows
