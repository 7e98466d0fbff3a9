"""The queries of this subpackage and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from lakeload.llm.bpe import op10_bpe_transducer
from lakeload.llm.collocations import OP11_SQL, op11_son_collocations
from lakeload.llm.fingerprints import op1_syncmer_fingerprints
from lakeload.llm.lexical_search import OP12_SQL, op12_bag_search
from lakeload.llm.license_scan import op3_license_scan
from lakeload.llm.mixing import OP7_SQL, op7_mix_sources
from lakeload.llm.near_dups import OP4_SQL, op4_bag_minhash
from lakeload.llm.repeats import OP9_SQL, op9_repeated_passages
from lakeload.llm.secret_scan import op8_secret_scan
from lakeload.llm.sharding import OP2_SQL, op2_byte_shards
from lakeload.llm.topk_search import OP5_SQL, op5_threshold_topk
from lakeload.llm.toxicity import op6_toxic_segments
from lakeload.llm.url_rules import OP13_SQL, op13_url_rules

QUERIES = {
    "op1_syncmer_fingerprints": op1_syncmer_fingerprints,
    "op2_byte_shards": op2_byte_shards,
    "op3_license_scan": op3_license_scan,
    "op4_bag_minhash": op4_bag_minhash,
    "op5_threshold_topk": op5_threshold_topk,
    "op6_toxic_segments": op6_toxic_segments,
    "op7_mix_sources": op7_mix_sources,
    "op8_secret_scan": op8_secret_scan,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_bpe_transducer": op10_bpe_transducer,
    "op11_son_collocations": op11_son_collocations,
    "op12_bag_search": op12_bag_search,
    "op13_url_rules": op13_url_rules,
}

ORACLE = {
    "op2_byte_shards": OP2_SQL,
    "op4_bag_minhash": OP4_SQL,
    "op5_threshold_topk": OP5_SQL,
    "op7_mix_sources": OP7_SQL,
    "op9_repeated_passages": OP9_SQL,
    "op11_son_collocations": OP11_SQL,
    "op12_bag_search": OP12_SQL,
    "op13_url_rules": OP13_SQL,
}
