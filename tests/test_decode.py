import random
from decimal import Decimal

import pytest
from pyspark.sql import Row

import abi_model as model
from abiflow.functions.abi_types import parse_type, parse_type_list
from abiflow.functions.decode import decode_frame


def w(x):
    return (x % (1 << 256)).to_bytes(32, "big")


def run(spark, types, payloads):
    """Decode each payload with the type list; [(values, error)]."""
    df = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(payloads)], "i int, data binary")
    n = len(types)
    rows = decode_frame(df, parse_type_list(types)).orderBy("i").collect()
    return [([r[f"p{k}"] for k in range(n)], r.error) for r in rows]


# Reference unit vectors: one type, offset 0.
GOLDEN = [
    ("address", bytes(12) + bytes.fromhex("910ed056ee239ae7e25f50f1e99255dc76d72e1c"),
     "910ed056ee239ae7e25f50f1e99255dc76d72e1c"),
    ("uint256", w(0x2A), Decimal(42)),
    ("int256", b"\xff" * 31 + b"\xd6", -42),
    ("bool", w(1), True),
    ("string", w(0x20) + w(13) + b"Hello, World!" + bytes(19), "Hello, World!"),
    ("bytes", w(0x20) + w(4) + bytes.fromhex("deadbeef") + bytes(28), bytes.fromhex("deadbeef")),
    ("bytes4", bytes.fromhex("deadbeef"), bytes.fromhex("deadbeef")),
    ("uint256[]", w(0x20) + w(3) + w(1) + w(2) + w(3), [Decimal(1), Decimal(2), Decimal(3)]),
    ("(uint256,bool)", w(0x2A) + w(1), Row(f0=Decimal(42), f1=True)),
]

# Error and edge vectors read from the decoding rules.
EXTRA = [
    ("uint256", b"", None, "OutOfBounds"),
    ("uint256", bytes(31), None, "OutOfBounds"),
    ("uint8", w(300), Decimal(300), None),
    ("uint256", w(2**64 - 1), Decimal(2**64 - 1), None),
    ("uint256", w(2**64), None, "IntegerOverflow"),
    ("uint256", w(2**255), None, "IntegerOverflow"),
    ("int256", w(-(2**63)), -(2**63), None),
    ("int256", w(2**63), None, "IntegerOverflow"),
    ("bool", w(2), False, None),
    ("bool", b"\xff" * 31 + b"\x01", True, None),
    ("address", b"\xff" * 12 + bytes(range(20)), bytes(range(20)).hex(), None),
    ("bytes32", bytes(31), None, "OutOfBounds"),
    ("bytes2[]", w(0x20) + w(3) + bytes(34), None, "OutOfBounds"),
    ("string", w(2**32), None, "InvalidUnsignedInteger"),
    ("string", w(0x20) + w(13) + bytes(5), None, "OutOfBounds"),
    ("string", w(0x20) + w(1) + b"\xff" + bytes(31), None, "Utf8Error"),
    ("uint256[]", w(0x20) + w(0), [], None),
    ("uint256[]", w(0x20) + w(2**32 - 1) + w(1), None, "OutOfBounds"),
    ("string[]", w(0x20) + w(2) + w(0x40) + w(0x80) + w(1) + b"a" + bytes(31) + w(1) + b"b" + bytes(31),
     ["a", "b"], None),
    ("uint256", w(7) + bytes(5), Decimal(7), None),
]


def test_golden_vectors(spark):
    for t, data, expected in GOLDEN:
        [(vals, err)] = run(spark, [t], [data])
        assert err is None, t
        assert vals[0] == expected, t


def test_error_and_edge_vectors(spark):
    for t, data, expected, err in EXTRA:
        [(vals, got_err)] = run(spark, [t], [data])
        assert got_err == err, (t, data.hex())
        assert vals[0] == expected, t


def test_two_parameters_fixed_bytes_then_bool(spark):
    [(vals, err)] = run(spark, ["bytes4", "bool"], [bytes.fromhex("deadbeef") + bytes(28) + w(1)])
    assert err is None and vals == [bytes.fromhex("deadbeef"), True]


def test_first_error_in_parameter_order(spark):
    # p0 overflows, p1 is out of bounds: the first one is reported
    [(vals, err)] = run(spark, ["uint256", "string"], [w(2**70)])
    assert err == "IntegerOverflow" and vals == [None, None]


# ---- randomised: Spark decoder equals the plain-Python model --------------

LEAVES = ["address", "uint256", "uint8", "int256", "int64", "bool", "string", "bytes", "bytes32", "bytes4", "bytes2"]


def random_type(rnd, depth=0):
    r = rnd.random()
    if depth < 2 and r < 0.2:
        return random_type(rnd, depth + 1) + "[]"
    if depth < 1 and r < 0.3:
        return "(" + ",".join(random_type(rnd, depth + 1) for _ in range(rnd.randint(1, 3))) + ")"
    return rnd.choice(LEAVES)


def random_value(rnd, t):
    k = t.kind
    if k == "address":
        return bytes(rnd.getrandbits(8) for _ in range(20)).hex()
    if k == "uint":
        return rnd.choice([0, 1, 255, 2**64 - 1, rnd.getrandbits(64)])
    if k == "int":
        return rnd.choice([0, -1, -(2**63), 2**63 - 1, rnd.getrandbits(63) - 2**62])
    if k == "bool":
        return rnd.random() < 0.5
    if k == "string":
        return "".join(rnd.choice("ab€é漢 \n") for _ in range(rnd.randint(0, 40)))
    if k == "bytes":
        return bytes(rnd.getrandbits(8) for _ in range(rnd.randint(0, 70)))
    if k == "fixed_bytes":
        return bytes(rnd.getrandbits(8) for _ in range(t.size))
    if k == "array":
        return [random_value(rnd, t.elem) for _ in range(rnd.randint(0, 4))]
    return tuple(random_value(rnd, f) for f in t.fields)


def mutate(rnd, data):
    r = rnd.random()
    if r < 0.35 or not data:
        return data
    if r < 0.65:
        return data[: rnd.randint(0, len(data))]
    b = bytearray(data)
    i = rnd.randrange(len(b))
    b[i] = rnd.choice([0, 1, 0x80, 0xFF, rnd.getrandbits(8)])
    return bytes(b)


def normalise(v):
    if isinstance(v, Row):
        return tuple(normalise(x) for x in v)
    if isinstance(v, (list, tuple)):
        return type(v)(normalise(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


@pytest.mark.parametrize("seed", range(12))
def test_random_payloads_match_model(spark, seed):
    rnd = random.Random(seed)
    texts = [random_type(rnd) for _ in range(rnd.randint(1, 4))]
    types = [parse_type(t) for t in texts]
    payloads = []
    for _ in range(25):
        values = [random_value(rnd, t) for t in types]
        payloads.append(mutate(rnd, model.encode(types, values)))
    got = run(spark, texts, payloads)
    for data, (vals, err) in zip(payloads, got):
        want_vals, want_err = model.decode(types, data)
        assert err == want_err, (texts, data.hex())
        if want_err is None:
            assert [normalise(v) for v in vals] == [normalise(v) for v in want_vals], (texts, data.hex())
        else:
            assert all(v is None for v in vals)


@pytest.mark.parametrize("seed", range(4))
def test_variant_decode_equals_typed_decode(spark, seed):
    from pyspark.sql import functions as F

    from abiflow.operators.decode_events import decode_mixed

    rnd = random.Random(100 + seed)
    rows, keys = [], []
    for k in range(3):
        # event type lists: no structs (a signature cannot hold one)
        texts = []
        while len(texts) < rnd.randint(1, 3):
            t = random_type(rnd)
            if "(" not in t:
                texts.append(t)
        types = [parse_type(t) for t in texts]
        key = ",".join(t.name for t in types)
        keys.append((key, texts))
        for _ in range(15):
            data = mutate(rnd, model.encode(types, [random_value(rnd, t) for t in types]))
            rows.append((len(rows), key, bytearray(data)))
    df = spark.createDataFrame(rows, "i int, type_key string, data binary")
    mixed = decode_mixed(df, [k for k, _ in keys]).select("i", "error", F.to_json("params").alias("j"))
    typed = None
    for key, texts in keys:
        part = decode_frame(df.where(F.col("type_key") == key), parse_type_list(texts))
        cols = [c for c in part.columns if c.startswith("p")]
        part = part.select("i", "error", F.to_json(
            F.when(F.col("error").isNull(), F.to_variant_object(F.struct(*cols)))).alias("j"))
        typed = part if typed is None else typed.unionByName(part)
    assert sorted(mixed.collect()) == sorted(typed.collect())


def test_many_type_lists_are_decoded_in_groups_over_the_same_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    from abiflow.operators import decode_events as DE

    monkeypatch.setattr(DE, "MAX_BRANCHES", 2)
    lists = [["uint256"] * k for k in range(1, 6)]
    rows = []
    for k, types in enumerate(lists):
        for v in range(3):
            rows.append((len(rows), ",".join(types), bytearray(b"".join(w(10 * k + v) for _ in types))))
    df = spark.createDataFrame(rows, "i int, type_key string, data binary")
    out = DE.decode_mixed(df, [",".join(t) for t in lists]).select("i", "error", F.to_json("params").alias("j"))
    got = {r.i: (r.error, r.j) for r in out.collect()}
    assert len(got) == len(rows)
    for i, key, _ in rows:
        n = len(key.split(","))
        val = 10 * (n - 1) + (i - sum(3 for _ in range(n - 1)))
        assert got[i] == (None, "{" + ",".join(f'"p{j}":{val}' for j in range(n)) + "}")
