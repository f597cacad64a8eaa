"""Column names of the raw files. All raw columns are read as strings."""

# Raw column names, in file order.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "clients": (
        "client_id", "client_name", "company_id", "country", "sector", "created_at", "updated_at_sys",
    ),
    "projects": (
        "project_id", "project_name", "project_code", "client_id", "client_code", "created_at",
        "updated_at_sys", "project_exportable",
    ),
    "campaigns": (
        "campaign_id", "campaign_code", "campaign_name", "project_id", "project_code", "client_code",
        "campaign_start_date", "campaign_end_date", "is_active", "campaign_state_id", "campaign_state",
        "total_visits_planned", "total_pos_planned", "visit_duration_minutes", "created_at",
        "updated_at_sys",
    ),
    "questions": (
        "question_id", "campaign_id", "campaign_code", "question_code", "question_name",
        "question_type", "question_category", "question_order", "question_is_highlighted",
        "image_associated", "created_at", "updated_at_sys",
    ),
    "workers": (
        "employee_id", "employee_first_name", "employee_active_status", "employee_hire_date",
        "employee_address_province", "employee_contract_type", "company_id", "created_at",
        "updated_at_sys",
    ),
    "pos": (
        "intervention_point_id", "intervention_point_code", "intervention_point_name",
        "intervention_point_address", "intervention_point_province", "intervention_point_locality",
        "intervention_point_postal_code", "intervention_point_latitude",
        "intervention_point_longitude", "intervention_point_is_active", "created_at", "updated_at",
    ),
    "routes": (
        "route_id", "route_code", "route_name", "campaign_id", "campaign_code", "route_start_date",
        "route_end_date", "route_status", "delegation_code", "recall_mail_sent", "created_at",
        "updated_at_sys",
    ),
    "route_employee": (
        "route_employee_id", "route_id", "employee_id", "main_employee", "ip_percentage",
        "created_at", "updated_at", "deleted_at",
    ),
    "visits": (
        "visit_id", "campaign_id", "campaign_code", "project_code", "intervention_point_id",
        "intervention_point_code", "route_id", "route_code", "visit_date", "visit_time",
        "visit_status", "visit_type", "is_client_billable", "created_at", "updated_at_sys",
    ),
    "responses": (
        "answer_id", "visit_id", "question_id", "campaign_code", "intervention_point_code",
        "question_type", "answer", "expected_answer", "created_at", "updated_at_sys",
    ),
}
