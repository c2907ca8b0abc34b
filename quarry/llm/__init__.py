"""Operators of a training-data pipeline; nothing else in the library imports this package.

Common conventions, unless an operator's docstring says otherwise:

- an operator names the columns it reads; other input columns are ignored, so
  they cannot clash with its own, and it returns exactly the columns listed;
- every input row gives its own output row(s): repeated rows are answered
  each, a null id stays a null id, a null text counts as the empty text;
- an empty table gives an empty result with the same columns.
"""
