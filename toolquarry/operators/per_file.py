"""Running a small parse helper over an Arrow batch of texts."""

import json
import warnings

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..schemas import struct


def parsed(find, found: T.StructType, once: bool = True):
    """Arrow UDF ``text -> struct<reason, detail, found: array<found>>``.

    ``find`` maps one text to a list of rows. A file that cannot be parsed becomes
    a row with a reason; it never fails the task. Null texts stay null. ``once`` keeps the
    optimizer from copying it, which SQL functions cannot have.
    """
    shape = struct(reason=T.StringType(), detail=T.StringType(), found=T.ArrayType(found))
    arrow_shape = to_arrow_type(shape)

    def one(text):
        try:
            rows = find(text)
            json.dumps(rows, ensure_ascii=False).encode("utf-8")  # lone surrogates
            return {"found": rows}
        except SyntaxError as e:
            return {"reason": "syntax_error", "detail": f"line {e.lineno}: {e.msg}"}
        except Exception as e:
            return {"reason": "parser_error", "detail": type(e).__name__}

    @F.arrow_udf(shape)
    def run(texts: pa.Array) -> pa.Array:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")  # odd escapes in the parsed sources
            rows = [one(t.as_py()) if t.is_valid else None for t in texts]
        return pa.array(rows, type=arrow_shape)

    # Evaluated once: a filter on its result must not run it a second time below.
    return run.asNondeterministic() if once else run
