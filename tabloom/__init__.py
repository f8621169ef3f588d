"""tabloom: table and text preparation, model fitting and model evaluation on Spark."""
