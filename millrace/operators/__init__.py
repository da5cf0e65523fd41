from millrace.operators.aggs import *  # noqa: F401,F403
from millrace.operators.intervals import best_open, join_overlap  # noqa: F401
from millrace.operators.joins import (  # noqa: F401
    drop_in, fill_grid, grid, join_asof, join_eq, join_list_member, join_on_expr,
    join_range, join_siblings, join_within, keep_in, match_fallback, snapshot, waterfall, with_scalar,
)
from millrace.operators.layout import cluster, modulo_parts, top  # noqa: F401
from millrace.operators.lists import list_pieces, number_rows, regroup, split_rows  # noqa: F401
from millrace.operators.ordering import dense_positions, with_position, with_running  # noqa: F401
from millrace.operators.patterns import drop_like  # noqa: F401
from millrace.operators.rules import apply_match, apply_rules, drop_where, select_where, update_from_agg  # noqa: F401
from millrace.operators.setops import constant_rows, printable, stack, with_header_rows  # noqa: F401
from millrace.operators.timeline import events_before, first_events  # noqa: F401
from millrace.operators.windows import (  # noqa: F401
    build_history, drop_repeats, dwell, label_order, movement, next_row, nth_row, previous_row, ranked, runs, share,
)
