"""One declared schema (DDL text) per landing record and warehouse table."""

from __future__ import annotations

from ideamill.settings import SLOTS

HISTORY = "valid_from timestamp, valid_to timestamp, is_current boolean"

# Landing records: dates are epoch milliseconds, as the JSON writer leaves them.
RAW_COMPANY = (
    "company_db_id long, company_name string, status_active boolean, "
    "created_at long, updated_at long"
)
RAW_USER = (
    "company_db_id long, user_db_id long, name string, last_name string, email string, "
    "position string, contract_profile string, area long, sub_area long, "
    "created_at long, updated_at long"
)
RAW_GOAL = (
    "goal_db_id long, company_id long, goal_name string, goal_description string, "
    "active boolean, is_private boolean, ideas_reception boolean, end_campaign long, "
    "created_at long, updated_at long"
)
RAW_ANSWER = (
    "idea_id long, field_id long, field_answer string, company_id long, title string, "
    "description string, form_field_id long, form_id long, idea_name string, "
    "idea_description string, created_at long, updated_at long"
)
RAW_CLUSTER = (
    "idea_db_id long, company_id long, goal_id long, cluster_number long, "
    "distance_centroid double, name string, description string, solution_1 string"
)

# Label response of the caller's model.
LABEL_ANSWER = (
    "ideas array<struct<index: string, idea_name: string, idea_description: string>>, "
    "cluster_name string, cluster_description string"
)

# Warehouse tables.
DIM_COMPANY = (
    "id long, company_db_id long, company_name string, status_active boolean, "
    "category string, country string, created_at date, updated_at date, " + HISTORY
)
DIM_USERS = (
    "id long, company_id long, user_db_id long, name string, last_name string, email string, "
    "position string, contract_profile string, area string, sub_area string, country string, "
    "created_at date, updated_at date, " + HISTORY
)
DIM_GOALS = (
    "id long, goal_db_id long, company_id long, goal_name string, goal_description string, "
    "active boolean, ideas_reception boolean, is_private boolean, end_campaign timestamp, "
    "created_at timestamp, updated_at timestamp, " + HISTORY
)
DIM_CATEGORIES = (
    "id long, id_category_db long, category_name string, category_description string, "
    "company_id long, status_active boolean, created_at timestamp, updated_at timestamp"
)
PARAM_CLASS_TABLE = (
    "id long, company_id long, field_id long, name string, description string, category string"
)
FACT_SUBMITTED_IDEA = (
    "id long, idea_id long, company_id long, user_id_1 long, user_id_2 long, user_id_3 long, "
    "user_id_4 long, users string, goal_id long, submitted_at timestamp"
)
PARAM_CLUSTERED_IDEAS = (
    "id long, idea_id long, idea_db_id long, company_id long, goal_id long, "
    "idea_c_name string, idea_c_description string, cluster_name string, "
    "cluster_description string, cluster_number long, distance_centroid double"
)


def numbered(family: str, slots: int = SLOTS) -> list[str]:
    """Column names of one numbered family; ``{}`` in the name takes the number."""
    return [family.format(i) for i in range(1, slots + 1)]


PROBLEMS, SOLUTIONS = numbered("problem_{}"), numbered("solution_{}")
PROBLEM_VECTORS, SOLUTION_VECTORS = numbered("prob_{}_embedded"), numbered("sol_{}_embedded")
FAMILIES = (PROBLEMS, SOLUTIONS, PROBLEM_VECTORS, SOLUTION_VECTORS)
VECTOR_COLUMNS = ["name_embedded"] + [
    column for pair in zip(PROBLEM_VECTORS, SOLUTION_VECTORS) for column in pair
]
# Category of an answer -> column of the wide idea row.
TEXT_COLUMN_OF = {
    f"{kind} {i}": f"{kind.lower()}_{i}"
    for kind in ("Problem", "Solution")
    for i in range(1, SLOTS + 1)
}
VECTOR_COLUMN_OF = {"Idea name": "name_embedded"} | {
    f"{kind} {i}": f"{short}_{i}_embedded"
    for kind, short in (("Problem", "prob"), ("Solution", "sol"))
    for i in range(1, SLOTS + 1)
}
IDEA_ATTRIBUTES = [
    "tag_name", "tag_description", "tag_type", "is_private", "category", "stage",
    "like_ideas_count", "average_general", "name", "description",
]
