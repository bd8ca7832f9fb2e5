"""Domain dataflows composed from the operators (staging, air quality, fires, features, models)."""
