"""CRC-32C of many byte strings at once, and the masked form that record files store."""

from __future__ import annotations

import numpy as np

_BLOCK = 256
_POLYNOMIAL = 0x82F63B78  # Castagnoli, bits reversed


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_BYTE = _byte_table()
_PAIRS = np.arange(1 << 16, dtype=np.uint32)
_PAIR = _BYTE[(_BYTE[_PAIRS & 0xFF] ^ (_PAIRS >> 8)) & 0xFF] ^ (_BYTE[_PAIRS & 0xFF] >> 8)


def _shift_table(basis: np.ndarray) -> np.ndarray:
    """Lookup by the four bytes of a state for a linear step given by its images of single bits."""
    values = np.arange(256)
    table = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            table[byte] ^= np.where(values >> bit & 1, basis[8 * byte + bit], 0).astype(np.uint32)
    return table


def _shifted(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    return table[0][state & 0xFF] ^ table[1][state >> 8 & 0xFF] ^ table[2][state >> 16 & 0xFF] ^ table[3][state >> 24]


def _shift_tables(n: int) -> list[np.ndarray]:
    """Steps over 1, 2, 4, ... blocks of zero bytes."""
    basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(_BLOCK):
        basis = _BYTE[basis & 0xFF] ^ (basis >> 8)
    out = []
    for _ in range(n):
        out.append(_shift_table(basis))
        basis = _shifted(out[-1], basis)
    return out


_SHIFTS = _shift_tables(24)


def _short(data: bytes) -> int:
    state = 0xFFFFFFFF
    for byte in data:
        state = int(_BYTE[(state ^ byte) & 0xFF]) ^ (state >> 8)
    return state ^ 0xFFFFFFFF


def crc32c(parts: list[bytes]) -> np.ndarray:
    """Checksums of ``parts``.

    Parts are cut into blocks from the right. All blocks advance together, two bytes a step; their states are then
    joined in pairs, with zero blocks before odd ones, which change nothing.
    """
    if not parts:
        return np.zeros(0, np.uint32)
    sizes = np.array([len(p) for p in parts], np.int64)
    counts = np.maximum(-(-sizes // _BLOCK), 1)
    ends = np.cumsum(counts) * _BLOCK
    held = np.zeros(int(ends[-1]), np.uint8)
    for part, end in zip(parts, ends.tolist()):
        held[end - len(part): end] = np.frombuffer(part, np.uint8)
        held[end - len(part): min(end - len(part) + 4, end)] ^= 0xFF  # stands for the initial state of ones
    words = np.ascontiguousarray(held.view("<u2").reshape(-1, _BLOCK // 2).T)
    state = np.zeros(words.shape[1], np.uint32)
    for column in words:
        state = _PAIR[(state ^ column) & 0xFFFF] ^ (state >> 16)
    for table in _SHIFTS:
        if counts.max() == 1:
            break
        odd = counts & 1
        padded = counts + odd
        move = np.cumsum(padded) - padded + odd - (np.cumsum(counts) - counts)
        wide = np.zeros(int(padded.sum()), np.uint32)
        wide[np.arange(len(state)) + np.repeat(move, counts)] = state
        state = _shifted(table, wide[0::2]) ^ wide[1::2]
        counts = padded // 2
    out = ~state
    for i in np.flatnonzero(sizes < 4):
        out[i] = _short(parts[i])
    return out


def masked(parts: list[bytes]) -> np.ndarray:
    """The checksum turned by 15 bits with a constant added, so that checksums of checksums stay sound."""
    crc = crc32c(parts)
    return (crc >> 15 | crc << 17) + np.uint32(0xA282EAD8)
