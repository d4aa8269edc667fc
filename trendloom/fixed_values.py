"""Values that the results depend on, stated once."""

from __future__ import annotations

# The shipped tool dictionary. One line per tool:
# tool, category, pattern (lower-case regex alternation), excluded phrases (may be blank).
TOOL_DICTIONARY = """
Airflow,orchestration,airflow,
Dagster,orchestration,dagster,
Prefect,orchestration,prefect,
dbt,transformation,dbt,
SQLMesh,transformation,sqlmesh,
Snowflake,warehouse,snowflake,
BigQuery,warehouse,bigquery,
Redshift,warehouse,redshift,
ClickHouse,warehouse,clickhouse,
DuckDB,warehouse,duckdb|motherduck,
Databricks,lakehouse,databricks,
Microsoft Fabric,lakehouse,microsoft fabric|ms fabric|fabric,
Iceberg,table format,iceberg,
Delta Lake,table format,delta lake|delta table,
Hudi,table format,hudi,
Spark,processing,spark|pyspark,
Flink,processing,flink,
Trino,processing,trino|presto|starburst,
Kafka,streaming,kafka|confluent,
Airbyte,ingestion,airbyte,
Fivetran,ingestion,fivetran,
Postgres,database,postgres|postgresql,
MySQL,database,mysql,
SQL Server,database,sql server|mssql,
MongoDB,database,mongodb|mongo,
Pandas,dataframe,pandas,
Polars,dataframe,polars,
Power BI,bi,power bi|powerbi,
Tableau,bi,tableau,
Looker,bi,looker,
AI (general),ai,ai,
LLM,ai,llm|llms|gpt|chatgpt|claude|gemini,
AI Agent,ai,agent|agents|agentic,sql server agent|user-agent
MCP,ai,mcp,
RAG,ai,rag,
"""

# The category whose share of the conversation is tracked.
FOCUS_CATEGORY = "ai"

# Texts and accounts that stand for removed content or a bot.
REMOVED_TEXTS = ["[removed]", "[deleted]"]
EMPTY_TEXT = ""
DELETED_ACCOUNT = "[deleted]"
BOT_ACCOUNT = "AutoModerator"

# Typed id prefixes.
POST_PREFIX = "t3_"
COMMENT_PREFIX = "t1_"

# Labels in the marts and in what the dashboard and digest show.
NO_FLAIR = "No flair"
POST_TITLES = "Post titles"
COMMENTS = "Comments"
FIRST = "first"
LAST = "last"
FOCUS_GROUP = "AI tools"
OTHER_GROUP = "Other tools"
MAX_PICKED_TOOLS = 4
CURRENT_MONTH_MARK = " (so far)"
TOP_MOVERS = 3
FOCUS_RISING = "AI tools rising fastest"
OTHERS_RISING = "Other tools rising most"
OTHERS_FALLING = "Other tools falling most"

# Months per comparison window.
WINDOW_MONTHS = 6

# Accepted values and expectations of the data tests.
REMOVAL_REASONS = ["automod_filtered", "reddit", "moderator", "deleted", "content_takedown"]
POST_LATER_REMOVALS = ["automod_filtered", "reddit", "moderator", "deleted"]
COMMENT_LATER_REMOVALS = ["removed", "deleted", "removed by reddit"]
MULTI_WORD_TOOLS = ["Power BI", "SQL Server", "Delta Lake"]

# Freshness budget on event time, in hours.
FRESHNESS_WARN_HOURS = 36
FRESHNESS_ERROR_HOURS = 72
