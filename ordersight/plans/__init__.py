"""Plan shapes shared by the operators, chosen for large and skewed inputs."""
