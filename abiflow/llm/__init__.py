"""Training-data operators: sharding, quality, tokens, near-duplicates,
language, licences, packing, decontamination and personal data.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames with ``doc_id`` and ``text`` (other columns are ignored unless an
operator says otherwise), treats a null text as stated in its docstring and
returns one row per input row unless it says otherwise; a table without rows
gives a result without rows.
"""
