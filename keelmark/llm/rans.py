"""Static range asymmetric numeral system over token ids, interleaved and vectorised.

One shared frequency table serves all blocks. A block is coded in up to ``LANES`` lanes: token ``i`` belongs to lane
``i % lanes``, and all lanes share one stream of 32-bit words. Every ``STEPS`` steps a checkpoint holds the lane states
and the place in the stream, so each segment of a block can be decoded by itself; each has its own CRC-32.
"""

import struct
import zlib

import numpy as np

PRECISION = 20
LOW = 31  # states lie in [2**LOW, 2**(LOW + 32))
LANES = 1024
STEPS = 256
MAGIC = b"RANS1\0\0\0"
_U = np.uint64


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**PRECISION, at least one for each id that occurs."""
    total, room = int(counts.sum()), 1 << PRECISION
    if not total:
        return np.zeros(len(counts), np.int64)
    frequencies = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * room // total), 0).astype(np.int64)
    spare = room - int(frequencies.sum())
    for at in np.argsort(-frequencies, kind="stable"):
        change = spare if spare >= 0 else -min(-spare, int(frequencies[at]) - 1)
        frequencies[at] += change
        spare -= change
        if not spare:
            break
    return frequencies


class Coder:
    def __init__(self, frequencies: np.ndarray):
        self.frequency = frequencies.astype(_U)
        self.start = (np.cumsum(frequencies) - frequencies).astype(_U)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = max(1, min(LANES, n // 256))
        steps = -(-n // lanes)
        x = np.full(lanes, 1 << LOW, _U)
        words: list[np.ndarray] = []
        place, points = 0, []
        for step in range(steps - 1, -1, -1):
            part = ids[step * lanes: (step + 1) * lanes]
            f, s, state = self.frequency[part], self.start[part], x[: len(part)]
            full = state >= (f << _U(LOW + 32 - PRECISION))
            if full.any():
                words.append((state[full] & _U(0xFFFFFFFF)).astype("<u4"))
                place += len(words[-1])
                state = np.where(full, state >> _U(32), state)
            whole = state // f
            x[: len(part)] = (whole << _U(PRECISION)) + (state - whole * f) + s
            if step % STEPS == 0:
                crc = zlib.crc32(ids[step * lanes: (step + STEPS) * lanes].astype("<u4").tobytes())
                points.append((x.copy(), place, crc))
        points.reverse()
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        head = MAGIC + struct.pack("<QIII", n, lanes, len(points), len(stream))
        table = b"".join(struct.pack("<II", len(stream) - at, crc) + states.astype("<u8").tobytes() for states, at, crc in points)
        return head + table + stream.tobytes()

    def segments(self, block: bytes) -> int:
        return struct.unpack_from("<QIII", block, len(MAGIC))[2]

    def decode(self, block: bytes, segment: int | None = None) -> np.ndarray:
        """All ids of a block, or those of one segment; raises ValueError where a checksum fails."""
        if block[: len(MAGIC)] != MAGIC:
            raise ValueError("not a block of this format")
        n, lanes, points, size = struct.unpack_from("<QIII", block, len(MAGIC))
        first, entry = len(MAGIC) + 20, 8 + 8 * lanes
        stream = np.frombuffer(block, "<u4", size, first + points * entry)
        out = []
        for point in range(points) if segment is None else (segment,):
            place, crc = struct.unpack_from("<II", block, first + point * entry)
            x = np.frombuffer(block, "<u8", lanes, first + point * entry + 8).astype(_U)
            begin, end = point * STEPS * lanes, min(n, (point + 1) * STEPS * lanes)
            ids = np.empty(end - begin, np.uint32)
            for at in range(0, end - begin, lanes):
                state = x[: min(lanes, end - begin - at)]
                slot = state & _U((1 << PRECISION) - 1)
                symbol = self.symbol[slot]
                ids[at: at + len(state)] = symbol
                state = self.frequency[symbol] * (state >> _U(PRECISION)) + slot - self.start[symbol]
                low = state < _U(1 << LOW)
                need = int(np.count_nonzero(low))
                if need:
                    if place + need > size:
                        raise ValueError("the stream is too short")
                    state[low] = (state[low] << _U(32)) | stream[place: place + need].astype(_U)
                    place += need
                x[: len(state)] = state
            after = np.full(lanes, 1 << LOW, _U)
            if point + 1 < points:
                after = np.frombuffer(block, "<u8", lanes, first + (point + 1) * entry + 8)
            if zlib.crc32(ids.astype("<u4").tobytes()) != crc or (x != after).any():
                raise ValueError(f"checksum of segment {point} fails")
            out.append(ids)
        return np.concatenate(out) if out else np.zeros(0, np.uint32)
