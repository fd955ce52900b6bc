"""The named queries of this subpackage and the SQL of their results."""

from tallyloom.llm import line_join, lsh_forest, prefix_trie, secrets
from tallyloom.llm.best_fit import op13_best_fit_packing
from tallyloom.llm.chaining import op6_passage_chains
from tallyloom.llm.compression import op5_compression_bands
from tallyloom.llm.decontaminate import op8_spaced_seeds
from tallyloom.llm.html_blocks import op1_block_lstm
from tallyloom.llm.ordinal import op9_ordinal_quality
from tallyloom.llm.packing import op10_mixture_packing
from tallyloom.llm.token_counts import op7_token_counts
from tallyloom.llm.whitening import op12_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_block_lstm,
        secrets.op2_secret_scan,
        line_join.op3_line_join,
        lsh_forest.op4_lsh_forest,
        op5_compression_bands,
        op6_passage_chains,
        op7_token_counts,
        op8_spaced_seeds,
        op9_ordinal_quality,
        op10_mixture_packing,
        prefix_trie.op11_prefix_trie,
        op12_whitening,
        op13_best_fit_packing,
    )
}
# Trained models, compression, tokenizers and chained alignments have no SQL; they are tested against brute force.
ORACLE = {"op2_secret_scan": secrets.sql(), "op3_line_join": line_join.SQL, "op4_lsh_forest": lsh_forest.SQL, "op11_prefix_trie": prefix_trie.SQL}
