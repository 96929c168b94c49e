"""Queries of the subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import poisson_mix, tool_calls, voronoi_knn
from .fuzzy_lines import op10_fuzzy_lines
from .jaccard_join import op6_jaccard_join
from .maxent_lm import op7_maxent_lm
from .poisson_mix import op8_poisson_mix
from .splitters import op9_splitters
from .token_orc import op1_token_orc
from .tool_calls import op4_tool_calls
from .toxicity import op2_toxicity
from .turn_repair import op12_turn_repair
from .voronoi_knn import op3_voronoi_knn
from .weighted_sampling import op13_weighted_sampling
from .whitening import op11_whitening
from .wu_manber import op5_wu_manber

QUERIES = {
    "op1_token_orc": op1_token_orc,
    "op2_toxicity": op2_toxicity,
    "op3_voronoi_knn": op3_voronoi_knn,
    "op4_tool_calls": op4_tool_calls,
    "op5_wu_manber": op5_wu_manber,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_maxent_lm": op7_maxent_lm,
    "op8_poisson_mix": op8_poisson_mix,
    "op9_splitters": op9_splitters,
    "op10_fuzzy_lines": op10_fuzzy_lines,
    "op11_whitening": op11_whitening,
    "op12_turn_repair": op12_turn_repair,
    "op13_weighted_sampling": op13_weighted_sampling,
}

SQL: dict[str, str] = {
    "op3_voronoi_knn": voronoi_knn.SQL,
    "op4_tool_calls": tool_calls.SQL,
    "op8_poisson_mix": poisson_mix.SQL,
}
