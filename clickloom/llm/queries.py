"""The registered queries of this package, and their SQL where SQL can say the same."""

from __future__ import annotations

import corpus_pipeline
from clickloom.llm.chat import OP7_SQL, op7_chat_format
from clickloom.llm.decontaminate import OP6_SQL, op6_decontaminate
from clickloom.llm.embeddings import OP8_SQL, op8_embedding_dedup
from clickloom.llm.html import op10_html_text
from clickloom.llm.infill import OP11_SQL, op11_fill_in_middle
from clickloom.llm.jaccard import OP9_SQL, op9_jaccard_join
from clickloom.llm.language import op1_language_id
from clickloom.llm.lines import OP3_SQL, op3_line_dedup
from clickloom.llm.mixing import op4_mixing
from clickloom.llm.periodic import OP13_SQL, op13_periodic_runs
from clickloom.llm.substrings import OP5_SQL, op5_substring_dedup
from clickloom.llm.toxicity import op12_toxicity
from clickloom.llm.warc import OP2_SQL, op2_warc

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_warc": op2_warc,
    "op3_line_dedup": op3_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_chat_format": op7_chat_format,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_html_text": op10_html_text,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op2_warc": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op6_decontaminate": OP6_SQL,
    "op7_chat_format": OP7_SQL,
    "op8_embedding_dedup": OP8_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op13_periodic_runs": OP13_SQL,
}
