"""Sources: visit log, user profiles, tasks, and the testdata fixture views."""

from visitlens.sources.fixtures import user_info, visit_actions
from visitlens.sources.tasks import decode_params, load_params, read_tasks, task_by_id
from visitlens.sources.users import read_user_info
from visitlens.sources.visits import read_visit_table, read_visit_text

__all__ = [
    "decode_params",
    "load_params",
    "read_tasks",
    "read_user_info",
    "read_visit_table",
    "read_visit_text",
    "task_by_id",
    "user_info",
    "visit_actions",
]
