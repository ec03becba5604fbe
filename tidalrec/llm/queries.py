"""Registered queries of the subpackage and the SQL that must give the same rows."""

from __future__ import annotations

import corpus_pipeline
from tidalrec.llm.bestfit import op7_bestfit_packing
from tidalrec.llm.byte_cnn import op10_byte_cnn
from tidalrec.llm.lattice import op2_lattice_links
from tidalrec.llm.merge_dropout import op9_merge_dropout
from tidalrec.llm.importance import op8_importance_resampling
from tidalrec.llm.line_dedup import op13_line_dedup
from tidalrec.llm.notices import op6_fuzzy_notices
from tidalrec.llm.oracle import SQL as ORACLE
from tidalrec.llm.prefix_trie import op12_prefix_trie
from tidalrec.llm.reply_trees import op3_reply_trees
from tidalrec.llm.rule_ledger import op4_rule_ledger
from tidalrec.llm.tensor_minhash import op5_tensor_minhash
from tidalrec.llm.turn_repair import op11_turn_repair
from tidalrec.llm.wrappers import op1_wrappers


def pipeline(spark, sf_dir):
    """The stages of corpus_pipeline over documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    pipeline, op1_wrappers, op2_lattice_links, op3_reply_trees, op4_rule_ledger, op5_tensor_minhash, op6_fuzzy_notices, op7_bestfit_packing,
    op8_importance_resampling, op9_merge_dropout, op10_byte_cnn,
    op11_turn_repair, op12_prefix_trie, op13_line_dedup)}
SQL: dict[str, str] = ORACLE
