"""churnspark: subscription churn and retention analytics as Spark DataFrame operators."""
