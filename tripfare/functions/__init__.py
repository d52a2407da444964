"""Column-level building blocks; nothing here touches a DataFrame."""
