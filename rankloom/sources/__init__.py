from .tables import read_table
from .fixtures import (click_log, basket_log, item_props, item_props_parts,
                       user_factors, product_factors)
from .matrix_store import BucketedMatrix, joined_in_place
from .ratings_io import (MATRIX_COLUMNS, load_rating_matrix, write_rating_matrix,
                         read_events_csv, EVENTS_SCHEMA, ITEM_PROPS_SCHEMA)

__all__ = ["read_table", "click_log", "basket_log", "item_props", "item_props_parts",
           "user_factors", "product_factors", "MATRIX_COLUMNS", "load_rating_matrix",
           "write_rating_matrix", "read_events_csv", "BucketedMatrix", "joined_in_place", "EVENTS_SCHEMA", "ITEM_PROPS_SCHEMA"]
