"""Reference data of the tool-conversation domain, replaceable by parameter in every operator.

Task ids are neutral (``task_00`` to ``task_22``); tables marked as fixed values hold the domain's own content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Fixed values.  Tool name: (required arguments, optional arguments).
TOOL_SIGNATURES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "read_file": (("path",), ("file_path", "filepath")),
    "write_file": (("path", "content"), ("file_path", "filepath")),
    "create_directory": (("path",), ("directory",)),
    "list_files": ((), ("directory", "path", "dir")),
    "run_bash": (("command",), ("cmd",)),
    "run_python": (("code",), ("script",)),
    "web_search": (("query",), ("num_results", "count")),
    "fetch_url": (("url",), ()),
    "create_calendar_event": (("title", "date", "time"), ("attendees", "description", "filename", "summary", "start_time", "end_time", "duration")),
    "draft_email": (("to", "subject", "body"), ("cc", "recipient")),
    "search_emails": (("query",), ("folder", "mailbox")),
    "read_email": (("email_id",), ("id",)),
    "generate_image": (("prompt",), ("filename", "output_path", "path", "output", "file")),
    "read_memory": ((), ("key", "query")),
    "write_memory": (("key", "value"), ()),
    "search_skills": (("query",), ("search", "term")),
    "install_skill": (("name",), ("skill_name", "skill")),
}

#: Fixed values.  Wrong tool name: the tool that was meant.
TOOL_TYPOS = {
    "image": "generate_image", "create_image": "generate_image", "gen_image": "generate_image", "image_gen": "generate_image",
    "execute_python": "run_python", "exec_python": "run_python", "python": "run_python",
    "execute_bash": "run_bash", "exec_bash": "run_bash", "bash": "run_bash", "shell": "run_bash",
    "file_read": "read_file", "file_write": "write_file", "read": "read_file", "write": "write_file",
    "list_dir": "list_files", "list_directory": "list_files", "ls": "list_files", "mkdir": "create_directory",
    "search": "web_search", "google": "web_search",
    "email": "draft_email", "send_email": "draft_email",
    "find_email": "search_emails", "email_search": "search_emails", "email_lookup": "search_emails",
    "calendar": "create_calendar_event",
    "memory_read": "read_memory", "memory_write": "write_memory", "get_memory": "read_memory",
    "set_memory": "write_memory", "store_memory": "write_memory",
}

WRITE_TOOLS = ("write_file", "draft_email", "create_calendar_event", "generate_image", "write_memory")

#: Neutral task ids; a registry of one's own is passed in their place.
TASK_IDS = tuple(f"task_{i:02d}" for i in range(23))
#: Fixed values.  Task: the tools its examples have to call.
REQUIRED_TOOLS: dict[str, tuple[str, ...]] = {
    "task_01": ("write_file",),
    "task_02": ("web_search",),
    "task_03": ("write_file",),
    "task_04": ("write_file",),
    "task_05": ("read_file", "write_file"),
    "task_06": ("web_search",),
    "task_07": ("write_file",),
    "task_08": ("read_file", "write_file"),
    "task_09": ("create_directory", "write_file"),
    "task_10": ("write_file",),
    "task_11": ("read_file", "write_file"),
    "task_12": (),
    "task_13": ("generate_image",),
    "task_14": ("read_file", "write_file"),
    "task_15": ("read_file", "write_file"),
    "task_16": ("list_files", "read_file", "write_file"),
    "task_17": ("list_files", "read_file"),
    "task_18": ("web_search", "write_file"),
    "task_19": ("read_file", "write_file"),
    "task_20": ("read_file", "write_file"),
    "task_21": ("read_file",),
    "task_22": (),
}
TOOL_REQUIRED_TASKS = tuple(t for t in TASK_IDS if t not in ("task_00", "task_03"))
#: Fixed values.  Task: what its examples have to mention.
EXPECTED_VALUES: dict[str, tuple[str, ...]] = {
    "task_08": ("June 1, 2024",),
    "task_21": ("5,705", "2,999", "SKILL.md", "February 7, 2026"),
    "task_19": ("119,900", "47,960", "Alice Chen", "Widget B"),
}
EXTERNAL_TASKS = ("task_02", "task_04", "task_06", "task_13", "task_18")
EXEMPT_TASKS = ("task_00",)
HARD_TASKS = ("task_02", "task_09", "task_16")

#: Fixed values.  Variation id: whether it rehearses an error.
VARIATIONS = {
    "happy_formal": False, "happy_casual": False, "vague_input": False, "error_recovery": True, "multi_tool_chain": False,
    "terse": False, "detailed_user": False, "one_clarification": False, "self_correction": False,
}

#: How a complete message ends, by the first and by the second validator, and contents that stand for a missing result.
TERMINALS = ".!?\"')}>"
TERMINALS_RECORD = ".!?\")}'`"
PLACEHOLDERS = ("...", "TODO", "placeholder", "result")


def task_table(spark: SparkSession, tasks: tuple[str, ...] = TASK_IDS) -> DataFrame:
    """(task_id, ordinal): the registry, a fixed number of rows."""
    return spark.createDataFrame([(t, i) for i, t in enumerate(tasks)], "task_id string, ordinal int")


def variation_table(spark: SparkSession, variations: dict[str, bool] = VARIATIONS) -> DataFrame:
    return spark.createDataFrame([(i, k, e) for i, (k, e) in enumerate(variations.items())], "variation_no int, variation_id string, has_error boolean")
