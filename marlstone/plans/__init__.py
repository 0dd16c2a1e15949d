"""The data model: silver, dimensions, fact, marts, KPIs."""
