"""Training-data operators: token stores, quality, mixing, archives, dedup.

Nothing outside this subpackage imports it.  Shared conventions:

* only the named id / text columns of an input are read; extra columns are
  ignored by decision operators and carried untouched by ``annotate_*`` ones,
  where an input column that clashes with an output name is replaced;
* a null text counts as the empty text unless an operator says otherwise;
* repeated rows stay repeated, empty tables give empty results of the same
  schema.
"""
