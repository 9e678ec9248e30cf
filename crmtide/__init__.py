"""PySpark-native lakehouse analytics for multi-tenant CRM data."""
