from teampulse.operators.merge import upsert  # noqa: F401
from teampulse.operators.ranking import positions, rank_desc, rank_top_k, top_n_per_group  # noqa: F401
from teampulse.operators.sides import stack_sides  # noqa: F401
