from dayshape.functions.numeric import (
    floor_bin,
    group_index,
    half_up,
    index_of,
    middle,
    spread,
)

__all__ = ["floor_bin", "group_index", "half_up", "index_of", "middle", "spread"]
