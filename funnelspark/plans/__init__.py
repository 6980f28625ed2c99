"""Silver tables, gold views, reports and the stages that run them in order."""
