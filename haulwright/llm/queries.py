"""The registered queries of this subpackage, and their DuckDB statements where SQL can say the same."""

from __future__ import annotations

import corpus_pipeline
from haulwright.llm import neardup, phrases, warc
from haulwright.llm.ann import op3_multi_index_hashing
from haulwright.llm.counts import op9_token_counts
from haulwright.llm.langid import op6_language_id
from haulwright.llm.neardup import op4_chosen_path
from haulwright.llm.packing import op5_best_fit_packing
from haulwright.llm.pieces import op10_sentencepiece
from haulwright.llm.phrases import op12_phrase_collocations
from haulwright.llm.pii import op1_personal_data
from haulwright.llm.quality import op2_divergence
from haulwright.llm.suffix import op7_repeated_spans
from haulwright.llm.toxicity import op11_nearest_examples
from haulwright.llm.turns import op13_conversation_repair
from haulwright.llm.warc import op8_arc_to_warc

QUERIES = {
    "op1_personal_data": op1_personal_data,
    "op2_divergence": op2_divergence,
    "op3_multi_index_hashing": op3_multi_index_hashing,
    "op4_chosen_path": op4_chosen_path,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_language_id": op6_language_id,
    "op7_repeated_spans": op7_repeated_spans,
    "op8_arc_to_warc": op8_arc_to_warc,
    "op9_token_counts": op9_token_counts,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_nearest_examples": op11_nearest_examples,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op4_chosen_path": neardup.ORACLE,
    "op8_arc_to_warc": warc.ORACLE,
    "op12_phrase_collocations": phrases.ORACLE,
}

if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
