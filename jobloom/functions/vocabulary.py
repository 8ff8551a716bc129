"""The skill vocabulary: canonical skill -> phrases that stand for it.

Callers may pass any other mapping; everything below only fills the default.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

# Results depend on these exact words.
SKILL_ALIASES: dict[str, list[str]] = {
    # languages
    "python": ["python"],
    "java": ["java"],
    "javascript": ["javascript", "js"],
    "typescript": ["typescript"],
    "c++": ["c++"],
    "c#": ["c#"],
    "go": ["golang", "go"],
    "rust": ["rust"],
    "scala": ["scala"],
    "kotlin": ["kotlin"],
    "swift": ["swift"],
    "ruby": ["ruby"],
    "php": ["php"],
    "r": ["r"],
    "matlab": ["matlab"],
    # stores
    "sql": ["sql"],
    "mysql": ["mysql"],
    "postgresql": ["postgresql", "postgres"],
    "sqlite": ["sqlite"],
    "mongodb": ["mongodb", "mongo"],
    "redis": ["redis"],
    "cassandra": ["cassandra"],
    "elasticsearch": ["elasticsearch", "elastic search"],
    # web
    "html": ["html"],
    "css": ["css", "scss", "sass"],
    "react": ["react", "react.js", "reactjs"],
    "next.js": ["next.js", "nextjs"],
    "vue": ["vue", "vue.js", "vuejs"],
    "angular": ["angular", "angular.js", "angularjs"],
    "node.js": ["node.js", "nodejs", "node js"],
    "express": ["express", "express.js", "expressjs"],
    "django": ["django"],
    "flask": ["flask"],
    "fastapi": ["fastapi"],
    "spring": ["spring", "spring boot"],
    # data and models
    "pandas": ["pandas"],
    "numpy": ["numpy", "np"],
    "scikit-learn": ["scikit-learn", "sklearn"],
    "pytorch": ["pytorch"],
    "tensorflow": ["tensorflow", "tf"],
    "keras": ["keras"],
    "xgboost": ["xgboost"],
    "lightgbm": ["lightgbm", "lgbm"],
    "spark": ["spark"],
    "pyspark": ["pyspark"],
    "airflow": ["airflow"],
    "kafka": ["kafka"],
    "mlflow": ["mlflow"],
    "dbt": ["dbt"],
    "hadoop": ["hadoop"],
    "snowflake": ["snowflake"],
    "bigquery": ["bigquery"],
    "redshift": ["redshift"],
    # cloud
    "aws": ["aws", "amazon web services"],
    "azure": ["azure", "microsoft azure"],
    "gcp": ["gcp", "google cloud", "google cloud platform"],
    "docker": ["docker"],
    "kubernetes": ["kubernetes", "k8s"],
    "helm": ["helm"],
    "terraform": ["terraform"],
    "ansible": ["ansible"],
    "jenkins": ["jenkins"],
    "github actions": ["github actions"],
    "gitlab ci": ["gitlab ci"],
    "linux": ["linux"],
    # tools
    "git": ["git"],
    "jira": ["jira"],
    "confluence": ["confluence"],
    "tableau": ["tableau"],
    "power bi": ["power bi"],
    "looker": ["looker"],
    "superset": ["superset"],
    # model operations
    "mlops": ["mlops"],
    "feature store": ["feature store"],
    "kubeflow": ["kubeflow"],
    "ray": ["ray"],
}

# Topic phrases that are their own canonical skill. Phrases that
# SKILL_ALIASES already has as canonicals are not repeated here.
TOPIC_SKILLS: list[str] = [
    # computer science basics
    "computer science fundamentals", "data structures", "arrays", "linked lists", "stacks",
    "queues", "hash tables", "trees", "binary trees", "binary search trees", "tries", "heaps",
    "priority queues", "graphs", "adjacency matrix", "adjacency list", "dynamic programming",
    "recursion", "divide and conquer", "greedy algorithms", "backtracking", "time complexity",
    "space complexity", "big o notation", "algorithm design", "computational complexity",
    "memory management",
    # algorithms
    "sorting algorithms", "merge sort", "quick sort", "heap sort", "bubble sort",
    "insertion sort", "selection sort", "binary search", "graph algorithms",
    "breadth first search", "bfs", "depth first search", "dfs", "shortest path",
    "dijkstra algorithm", "bellman ford", "minimum spanning tree", "kruskal", "prim",
    "string algorithms", "kmp", "rabin karp", "suffix arrays", "search algorithms",
    "path finding algorithms",
    # paradigms
    "object oriented programming", "oop", "inheritance", "polymorphism", "abstraction",
    "encapsulation", "functional programming", "event driven programming",
    "asynchronous programming", "concurrency", "parallelism", "multithreading",
    "synchronization", "message passing", "design patterns", "singleton", "factory pattern",
    "observer pattern", "adapter pattern",
    # system design
    "system design", "distributed systems", "scalability", "fault tolerance", "load balancing",
    "caching", "content delivery networks", "cdn", "database sharding", "partitioning",
    "replication", "microservices", "event driven architecture", "message queues",
    "pubsub systems", "api design", "rest apis", "grpc", "rate limiting", "high availability",
    "eventual consistency",
    # databases
    "postgres", "sql server", "oracle", "nosql", "dynamodb", "bigtable", "data modeling",
    "query optimization", "indexing",
    # backend
    "backend engineering", "nodejs", "api development", "authentication", "authorization",
    "jwt", "oauth", "session management", "web frameworks", "spring boot", "rails",
    # frontend
    "frontend engineering", "svelte", "responsive design", "web accessibility", "ui design",
    "ux design", "web performance optimization", "webpack", "vite",
    # operations
    "devops", "cloud computing", "ci cd", "monitoring", "prometheus", "grafana", "logging",
    "elk stack", "reverse proxy", "nginx", "serverless computing",
    # networks and security
    "computer networks", "tcp/ip", "http", "https", "dns", "ssl", "tls", "network security",
    "encryption", "authentication protocols", "penetration testing", "vulnerability scanning",
    "secure coding",
    # machine learning
    "machine learning", "deep learning", "data science", "statistics", "probability",
    "linear regression", "logistic regression", "random forest", "svm", "neural networks",
    "nlp", "computer vision", "matplotlib", "scikit learn",
    # practices
    "unit testing", "integration testing", "test driven development", "tdd", "version control",
    "clean code", "refactoring", "debugging", "deployment pipelines",
    "architecture documentation",
]

# Canonicals dropped after matching because the bare word is ambiguous.
SKILL_STOPWORDS = ("r", "go", "spring")


def extend_vocabulary(
    vocabulary: Mapping[str, Iterable[str]], phrases: Iterable[str]
) -> dict[str, list[str]]:
    """Add each phrase as its own canonical skill unless that canonical exists."""
    out = {skill: [p.strip() for p in alts] for skill, alts in vocabulary.items()}
    for phrase in phrases:
        out.setdefault(phrase.lower(), [phrase.lower()])
    return out


def default_vocabulary() -> dict[str, list[str]]:
    return extend_vocabulary(SKILL_ALIASES, TOPIC_SKILLS)


def phrase_rows(vocabulary: Mapping[str, Iterable[str]], stopwords=SKILL_STOPWORDS):
    """Sorted ``(phrase, skill)`` rows, without stopword canonicals."""
    drop = set(stopwords)
    return sorted(
        {(p.strip(), s) for s, alts in vocabulary.items() if s not in drop for p in alts}
    )
