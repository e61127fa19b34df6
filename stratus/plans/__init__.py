"""End-to-end plans: features, training, forecasting, oracle SQL."""
