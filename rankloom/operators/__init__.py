from .prep import (clean_events, union_parts, filter_property, latest_ts_per_key,
                   latest_per_key, events_with_category, events_per_visitor,
                   active_visitors, events_of_active, recode_events, weight_events, project_triple)
from .matrix import category_matrix, category_matrix_from_latest, visitor_matrix, collapse_pairs, to_ratings
from .profile import (distinct_ids, ratings_per_user, ratings_per_user_stats,
                      user_rating_crosstab, matrix_profile, contingency)
from .joins import Dimension, collect_garbage, discard, join_dimension, materialize, stored
from .ids import IdDictionary, RatingIds, numbered
from .audit import StageCounts, audited_category_matrix
from .latest import latest_candidates, latest_rows
from .sketches import SketchStore, part_sketches, relative_error
from .split import hash_split, random_split, row_split, fold_column

__all__ = [n for n in dir() if not n.startswith("_")]
