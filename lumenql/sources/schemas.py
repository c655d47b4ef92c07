"""Columns of the service tables."""

# Column names and types by table function. Objects without a type of their own are JSON text.
COLUMNS = {
    "airtable.base": "Id string, Name string, PrimaryFieldId string",
    "airtable.bases": "Id string, Name string, PermissionLevel string",
    "docker.containers": "ID string, Names array<string>, Image string, ImageID string, Command string, Created timestamp, Ports array<string>, SizeRw bigint, SizeRootFs bigint, Labels map<string,string>, State string, Status string, NetworkSettings string, Mounts string, FlattenPorts string",
    "docker.images": "Containers bigint, Created timestamp, ID string, Labels map<string,string>, ParentID string, RepoDigests array<string>, RepoTags array<string>, SharedSize bigint, Size bigint, VirtualSize bigint",
    "docker.networks": "Name string, ID string, Created timestamp, Scope string, Driver string, EnableIPv6 boolean, IPAM string, Internal boolean, Attachable boolean, Ingress boolean, ConfigFrom string, ConfigOnly boolean, Containers string, Options map<string,string>, Labels map<string,string>, Peers string, Services string",
    "docker.volumes": "CreatedAt string, Driver string, Labels map<string,string>, Mountpoint string, Name string, Options map<string,string>, Scope string, Status map<string,string>, UsageData string",
    "github.branches": "Name string, CommitSha string, CommitUrl string, Protected boolean, RepositoryOwner string, RepositoryName string",
    "github.commits": "Sha string, ShortSha string, Message string, Url string, AuthorName string, AuthorEmail string, AuthorLogin string, AuthorId bigint, AuthorDate timestamp, CommitterName string, CommitterEmail string, CommitterLogin string, CommitterId bigint, CommitterDate timestamp, Additions int, Deletions int, Total int, ParentShas string, ParentCount int, CommentCount int, Verified boolean, VerificationReason string, FilesChanged int",
    "github.issues": "Id bigint, Number int, Title string, Body string, State string, Url string, AuthorLogin string, AuthorId bigint, AssigneeLogin string, Assignees string, Labels string, LabelNames array<string>, MilestoneTitle string, MilestoneNumber int, Comments int, IsPullRequest boolean, CreatedAt timestamp, UpdatedAt timestamp, ClosedAt timestamp, ClosedByLogin string, Locked boolean, ActiveLockReason string, RepositoryUrl string, StateReason string",
    "github.pullrequests": "Id bigint, Number int, Title string, Body string, State string, Url string, AuthorLogin string, AuthorId bigint, AssigneeLogin string, Assignees string, Labels string, LabelNames array<string>, MilestoneTitle string, MilestoneNumber int, HeadRef string, HeadSha string, HeadRepository string, BaseRef string, BaseSha string, BaseRepository string, Merged boolean, Mergeable boolean, MergeableState string, MergedByLogin string, MergeCommitSha string, Comments int, Commits int, Additions int, Deletions int, ChangedFiles int, Draft boolean, CreatedAt timestamp, UpdatedAt timestamp, ClosedAt timestamp, MergedAt timestamp, Locked boolean, ActiveLockReason string",
    "github.releases": "Id bigint, TagName string, Name string, Body string, Url string, TargetCommitish string, Draft boolean, Prerelease boolean, AuthorLogin string, AuthorId bigint, CreatedAt timestamp, PublishedAt timestamp, AssetsCount int, TarballUrl string, ZipballUrl string",
    "github.repositories": "Id bigint, Name string, FullName string, Description string, Url string, CloneUrl string, SshUrl string, DefaultBranch string, IsPrivate boolean, IsFork boolean, IsArchived boolean, Language string, ForksCount int, StargazersCount int, WatchersCount int, OpenIssuesCount int, Size bigint, CreatedAt timestamp, UpdatedAt timestamp, PushedAt timestamp, OwnerLogin string, License string, Topics array<string>, HasIssues boolean, HasWiki boolean, HasDownloads boolean, Visibility string",
    "jira.comments": "Id string, IssueKey string, Body string, Author string, AuthorDisplayName string, UpdateAuthor string, UpdateAuthorDisplayName string, CreatedAt timestamp, UpdatedAt timestamp, VisibilityGroup string, VisibilityRole string",
    "jira.issues": "Key string, Id string, Summary string, Description string, Type string, Status string, Priority string, Resolution string, Assignee string, AssigneeDisplayName string, Reporter string, ReporterDisplayName string, ProjectKey string, CreatedAt timestamp, UpdatedAt timestamp, ResolvedAt timestamp, DueDate timestamp, Labels string, Components string, FixVersions string, AffectsVersions string, OriginalEstimateSeconds bigint, RemainingEstimateSeconds bigint, TimeSpentSeconds bigint, OriginalEstimate string, RemainingEstimate string, TimeSpent string, ParentKey string, Environment string, Votes bigint, SecurityLevel string, Url string, CustomFields map<string,string>",
    "jira.projects": "Id string, Key string, Name string, Description string, Lead string, Url string, Category string, CategoryDescription string, AvatarUrl string",
    "kubernetes.configmaps": "Namespace string, Name string, Age timestamp",
    "kubernetes.cronjobs": "Namespace string, Name string, Schedule string, Statuses string, LastScheduleTime timestamp",
    "kubernetes.daemonsets": "Namespace string, Name string, Desired int, Current int, Ready int, UpToDate int, Available int, Age timestamp",
    "kubernetes.deployments": "Namespace string, Name string, CreationTimestamp timestamp, Generation bigint, ResourceVersion string, Images string, ImagePullPolicies string, RestartPolicy string, ContainersNames string, Status string",
    "kubernetes.events": "Action string, ApiVersion string, Count int, EventTime timestamp, FirstTimestamp timestamp, InvolvedObject string, Kind string, LastTimestamp timestamp, Message string, Metadata struct<Name:string,Namespace:string,Labels:map<string,string>,Annotations:map<string,string>>, Reason string, Related string, ReportingComponent string, ReportingInstance string, Series string, Source string, Type string",
    "kubernetes.ingresses": "Namespace string, Name string, Class string, Hosts string, Address string, Ports string, Age timestamp",
    "kubernetes.jobs": "Namespace string, Name string, Completions int, Duration interval day to second, Images string, Containers string, Age timestamp",
    "kubernetes.nodes": "Name string, Status string, Roles string, Age timestamp, Version string, Kernel string, OS string, Architecture string, ContainerRuntime string, Cpu string, Memory string",
    "kubernetes.persistentvolumeclaims": "Namespace string, Name string, Capacity string, Volume string, Status string, Age timestamp",
    "kubernetes.persistentvolumes": "Name string, Namespace string, AccessModes string, ReclaimPolicy string, Status string, Claim string, StorageClass string, Reason string, Age timestamp",
    "kubernetes.podcontainers": "Namespace string, Name string, ContainerName string, Image string, ImagePullPolicy string, Age timestamp, SecurityContext string, Stdin boolean, StdinOnce boolean, TerminationMessagePath string, TerminationMessagePolicy string, Tty boolean, WorkingDir string",
    "kubernetes.podlogs": "Namespace string, Name string, ContainerName string, Line string",
    "kubernetes.pods": "Namespace string, Name string, ContainersNames string, PF string, Ready boolean, Restarts string, Statuses string, IP string, Metadata struct<Name:string,Namespace:string,Labels:map<string,string>,Annotations:map<string,string>>",
    "kubernetes.replicasets": "Namespace string, Name string, Desired int, Current int, Ready int, Age timestamp",
    "kubernetes.services": "Metadata struct<Name:string,Namespace:string,Labels:map<string,string>,Annotations:map<string,string>>, Spec string, Kind string, Status string",
    "kubernetes.statefulsets": "Namespace string, Name string, Replicas int, Age timestamp",
}
