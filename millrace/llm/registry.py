"""The queries of this package and the SQL that checks them."""

from millrace.llm import op6_preferences as op6
from millrace.llm import op9_line_dedup as op9
from millrace.llm import op10_url_filters as op10
from millrace.llm.op1_embedding_dedup import op1_embedding_dedup
from millrace.llm.op2_jaccard_join import op2_jaccard_join
from millrace.llm.op3_hilbert_search import op3_hilbert_search
from millrace.llm.op4_language_id import op4_language_id
from millrace.llm.op5_pii import op5_pii
from millrace.llm.op7_byte_bpe import op7_byte_bpe
from millrace.llm.op8_packing import op8_packing
from millrace.plans.ship import ship


def _with_package(query):
    def run(spark, folder):
        ship(spark)
        return query(spark, folder)

    return run


#: Queries that run Python on executors.
_FREE = [op1_embedding_dedup, op2_jaccard_join, op3_hilbert_search, op4_language_id, op7_byte_bpe, op8_packing]
_NATIVE = [op5_pii, op6.op6_preferences, op9.op9_line_dedup, op10.op10_url_filters]

QUERIES = {q.__name__: _with_package(q) for q in _FREE} | {q.__name__: q for q in _NATIVE}
SQL = {"op6_preferences": op6.SQL, "op9_line_dedup": op9.SQL, "op10_url_filters": op10.SQL}
