"""Event names and their groupings. All fixed values of the event contract."""

# fixed values: events that count as product activity
ACTIVITY_EVENTS = [
    "workspace_created",
    "project_created",
    "task_created",
    "task_assigned",
    "task_commented",
    "task_completed",
    "integration_connected",
]

# fixed values: event -> feature code
FEATURE_OF_EVENT = {
    "workspace_created": "workspace",
    "project_created": "projects",
    "task_created": "tasks",
    "task_assigned": "tasks",
    "task_completed": "tasks",
    "task_commented": "comments",
    "integration_connected": "integrations",
}

# fixed values: feature code -> label
FEATURE_LABELS = {
    "workspace": "Workspace",
    "projects": "Projects",
    "tasks": "Tasks",
    "comments": "Comments",
    "integrations": "Integrations",
}

SIGNUP_EVENT = "account_created"

# fixed values: the four activation signals, output column -> event
ACTIVATION_SIGNALS = {
    "workspace_at": "workspace_created",
    "project_at": "project_created",
    "invite_at": "membership_invited",
    "task_done_at": "task_completed",
}
ACTIVATION_WINDOW_DAYS = 7

# fixed values: journey steps after signup, output suffix -> event
JOURNEY_STEPS = {
    "workspace": "workspace_created",
    "project": "project_created",
    "invite": "membership_invited",
    "task_created": "task_created",
    "task_completed": "task_completed",
}

# fixed values: labels of the onboarding funnel, in step order
FUNNEL_LABELS = [
    "Signup",
    "Workspace created",
    "Project created",
    "Teammate invited",
    "Task created",
    "Task completed",
]

# fixed values: properties flattened to columns in staging
FLATTENED_PROPERTIES = [
    "country",
    "channel",
    "workspace_id",
    "project_id",
    "task_id",
    "integration_type",
    "from_plan",
    "to_plan",
]

PAID_PLANS = ["pro", "enterprise"]
CANONICAL_PLANS = ["free", "trial", "pro", "enterprise"]
CANONICAL_COUNTRIES = ["US", "CA", "GB"]
LIVE_STATUSES = ["active", "trialing", "past_due"]

# upper bounds (exclusive) of the lifetime-event segments; anything above is "high"
ENGAGEMENT_BOUNDS = {"low": 10, "medium": 50}
