"""Property test: for random type lists and random (possibly damaged)
payloads, the Spark decoder gives the plain-Python model's values and error
class.  Each example decodes a batch of payloads in one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import abi_model as model
from abiflow.functions.abi_types import parse_type
from test_decode import normalise, run

LEAVES = ["address", "uint256", "uint8", "int256", "int64", "bool", "string", "bytes", "bytes32", "bytes4", "bytes2"]

type_text = st.recursive(
    st.sampled_from(LEAVES),
    lambda inner: st.one_of(
        inner.map(lambda t: t + "[]"),
        # struct fields are split on every comma, so fields are not structs
        st.lists(st.sampled_from(LEAVES), min_size=1, max_size=3).map(lambda fs: "(" + ",".join(fs) + ")"),
    ),
    max_leaves=3,
)


def value_of(t):
    k = t.kind
    if k == "address":
        return st.binary(min_size=20, max_size=20).map(bytes.hex)
    if k == "uint":
        return st.integers(0, 2**64 - 1)
    if k == "int":
        return st.integers(-(2**63), 2**63 - 1)
    if k == "bool":
        return st.booleans()
    if k == "string":
        return st.text(max_size=40)
    if k == "bytes":
        return st.binary(max_size=70)
    if k == "fixed_bytes":
        return st.binary(min_size=t.size, max_size=t.size)
    if k == "array":
        return st.lists(value_of(t.elem), max_size=4)
    return st.tuples(*[value_of(f) for f in t.fields])


@st.composite
def damaged(draw, data: bytes) -> bytes:
    how = draw(st.sampled_from(["keep", "cut", "flip"]))
    if how == "keep" or not data:
        return data
    if how == "cut":
        return data[: draw(st.integers(0, len(data)))]
    b = bytearray(data)
    b[draw(st.integers(0, len(b) - 1))] = draw(st.sampled_from([0, 1, 0x80, 0xFF]))
    return bytes(b)


@st.composite
def case(draw):
    texts = draw(st.lists(type_text, min_size=1, max_size=3))
    types = [parse_type(t) for t in texts]
    payloads = []
    for _ in range(draw(st.integers(1, 12))):
        values = [draw(value_of(t)) for t in types]
        payloads.append(draw(damaged(model.encode(types, values))))
    return texts, types, payloads


@settings(max_examples=10, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large, HealthCheck.function_scoped_fixture])
@given(case())
def test_decoder_equals_model(spark, c):
    texts, types, payloads = c
    got = run(spark, texts, payloads)
    for data, (vals, err) in zip(payloads, got):
        want_vals, want_err = model.decode(types, data)
        assert err == want_err, (texts, data.hex())
        if want_err is None:
            assert [normalise(v) for v in vals] == [normalise(v) for v in want_vals], (texts, data.hex())
        else:
            assert all(v is None for v in vals)
