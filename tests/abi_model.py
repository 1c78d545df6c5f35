"""Plain-Python model of the payload layout, written from the decoding rules
(SURVEY 2.5), used only by the tests: an encoder for valid payloads and a
sequential decoder that raises the first error class."""

from __future__ import annotations

from decimal import Decimal

from abiflow.functions.abi_types import AbiType

WORD = 32


class ModelError(Exception):
    def __init__(self, cls: str):
        super().__init__(cls)
        self.cls = cls


def _peek(data: bytes, off: int, n: int) -> bytes:
    if off + n > len(data):
        raise ModelError("OutOfBounds")
    return data[off : off + n]


def _size(data: bytes, off: int) -> int:
    w = _peek(data, off, WORD)
    if any(w[:28]):
        raise ModelError("InvalidUnsignedInteger")
    return int.from_bytes(w[28:], "big")


def decode_one(t: AbiType, data: bytes, off: int, base: int):
    k = t.kind
    if k == "address":
        return _peek(data, off, WORD)[12:].hex(), off + WORD
    if k == "uint":
        v = int.from_bytes(_peek(data, off, WORD), "big")
        if v >= 1 << 64:
            raise ModelError("IntegerOverflow")
        return Decimal(v), off + WORD
    if k == "int":
        v = int.from_bytes(_peek(data, off, WORD), "big", signed=True)
        if not -(1 << 63) <= v < (1 << 63):
            raise ModelError("IntegerOverflow")
        return v, off + WORD
    if k == "bool":
        return _peek(data, off, WORD)[31] == 1, off + WORD
    if k == "fixed_bytes":
        return _peek(data, off, t.size), off + WORD
    if k in ("string", "bytes"):
        p = base + _size(data, off)
        n = _size(data, p)
        body = _peek(data, p + WORD, n)
        if k == "string":
            try:
                return body.decode("utf-8"), off + WORD
            except UnicodeDecodeError:
                raise ModelError("Utf8Error")
        return body, off + WORD
    if k == "array":
        p = base + _size(data, off)
        n = _size(data, p)
        frame = p + WORD
        out, o = [], frame
        for _ in range(n):
            v, o = decode_one(t.elem, data, o, frame)
            out.append(v)
        return out, off + WORD
    if k == "struct":
        vals, o = [], off
        for f in t.fields:
            v, o = decode_one(f, data, o, base)
            vals.append(v)
        return tuple(vals), o
    raise ValueError(k)


def decode(types, data: bytes):
    """(values, None) or (None, error class)."""
    try:
        vals, off = [], 0
        for t in types:
            v, off = decode_one(t, data, off, 0)
            vals.append(v)
        return vals, None
    except ModelError as e:
        return None, e.cls


def _word(x: int) -> bytes:
    return (x % (1 << 256)).to_bytes(WORD, "big")


class _Frame:
    def __init__(self, types):
        self.head_size = sum(t.head for t in types)
        self.head = b""
        self.tail = b""

    def put(self, t: AbiType, v):
        k = t.kind
        if k == "address":
            self.head += bytes(12) + bytes.fromhex(v)
        elif k in ("uint", "int"):
            self.head += _word(int(v))
        elif k == "bool":
            self.head += _word(1 if v else 0)
        elif k == "fixed_bytes":
            self.head += v + bytes(WORD - len(v))
        elif k in ("string", "bytes"):
            b = v.encode("utf-8") if k == "string" else v
            self.head += _word(self.head_size + len(self.tail))
            pad = (-len(b)) % WORD
            self.tail += _word(len(b)) + b + bytes(pad)
        elif k == "array":
            self.head += _word(self.head_size + len(self.tail))
            self.tail += _word(len(v)) + encode([t.elem] * len(v), v)
        elif k == "struct":
            for f, x in zip(t.fields, v):
                self.put(f, x)
        else:
            raise ValueError(k)


def encode(types, values) -> bytes:
    fr = _Frame(types)
    for t, v in zip(types, values):
        fr.put(t, v)
    return fr.head + fr.tail
