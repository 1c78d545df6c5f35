"""ABI type text -> type tree -> Spark type, static head size, canonical name.

The tree is built once on the driver from a signature's type list; the
decoder compiles it into native Column expressions (see ``decode.py``), so
nothing here runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The accepted scalar type names (exact, case-sensitive), the
# kind each one parses to, and its canonical name.  Must equal the reference.
SCALAR_TYPES: dict[str, tuple[str, int, str]] = {
    "address": ("address", 0, "address"),
    "uint256": ("uint", 256, "uint256"),
    "uint128": ("uint", 128, "uint128"),
    "uint64": ("uint", 64, "uint64"),
    "uint32": ("uint", 32, "uint32"),
    "uint16": ("uint", 16, "uint16"),
    "uint8": ("uint", 8, "uint8"),
    "uint": ("uint", 256, "uint256"),
    "int256": ("int", 256, "int256"),
    "int128": ("int", 128, "int128"),
    "int64": ("int", 64, "int64"),
    "int32": ("int", 32, "int32"),
    "int16": ("int", 16, "int16"),
    "int8": ("int", 8, "int8"),
    "int": ("int", 256, "int256"),
    "bool": ("bool", 0, "bool"),
    "string": ("string", 0, "string"),
    "bytes": ("bytes", 0, "bytes"),
    "bytes32": ("fixed_bytes", 32, "bytes32"),
    "bytes16": ("fixed_bytes", 16, "bytes16"),
    "bytes8": ("fixed_bytes", 8, "bytes8"),
    "bytes4": ("fixed_bytes", 4, "bytes4"),
    "bytes2": ("fixed_bytes", 2, "bytes2"),
}

WORD = 32


class UnsupportedDataType(ValueError):
    """Type text that is not one of the accepted forms."""

    def __init__(self, text: str):
        super().__init__(f"UnsupportedDataType: {text}")
        self.text = text


@dataclass(frozen=True)
class AbiType:
    kind: str  # address | uint | int | bool | string | bytes | fixed_bytes | array | struct
    size: int = 0  # declared bits for uint/int, byte count for fixed_bytes
    elem: "AbiType | None" = None
    fields: tuple["AbiType", ...] = field(default_factory=tuple)

    @property
    def head(self) -> int:
        """Bytes this type advances the offset by: one word, or the sum of
        the fields for an inline struct."""
        if self.kind == "struct":
            return sum(f.head for f in self.fields)
        return WORD

    @property
    def name(self) -> str:
        if self.kind == "array":
            return f"{self.elem.name}[]"
        if self.kind == "struct":
            return "(" + ", ".join(f.name for f in self.fields) + ")"
        if self.kind in ("uint", "int"):
            return f"{self.kind}{self.size}"
        if self.kind == "fixed_bytes":
            return f"bytes{self.size}"
        return self.kind

    @property
    def spark_type(self) -> T.DataType:
        k = self.kind
        if k in ("address", "string"):
            return T.StringType()
        if k == "uint":
            # 64-bit host integer, unsigned: 0 .. 2^64-1
            return T.DecimalType(20, 0)
        if k == "int":
            return T.LongType()
        if k == "bool":
            return T.BooleanType()
        if k in ("bytes", "fixed_bytes"):
            return T.BinaryType()
        if k == "array":
            return T.ArrayType(self.elem.spark_type, True)
        return T.StructType(
            [T.StructField(f"f{i}", f.spark_type, True) for i, f in enumerate(self.fields)]
        )


def parse_type(text: str) -> AbiType:
    """Parse one type text.  Exact scalar names first, then ``(..)`` structs
    (split on every comma, so no nesting beyond one field), then ``T[]``."""
    if text in SCALAR_TYPES:
        kind, size, _ = SCALAR_TYPES[text]
        return AbiType(kind, size)
    if text.startswith("(") and text.endswith(")"):
        inner = text[1:-1]
        return AbiType("struct", fields=tuple(parse_type(p.strip()) for p in inner.split(",")))
    if text.endswith("[]"):
        return AbiType("array", elem=parse_type(text[:-2]))
    raise UnsupportedDataType(text)


def parse_type_list(texts) -> tuple[AbiType, ...]:
    return tuple(parse_type(t) for t in texts)


def tuple_type(types) -> T.StructType:
    """Spark row type of a decoded parameter list: p0, p1, .."""
    return T.StructType([T.StructField(f"p{i}", t.spark_type, True) for i, t in enumerate(types)])
