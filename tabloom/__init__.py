"""tabloom: analytics jobs on tables, series, text and vectors, written for Spark."""
